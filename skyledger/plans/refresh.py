"""Silver to gold, and the whole way from raw files to gold."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators.gold import (
    DAILY_WIDE,
    daily_tables,
    daily_wide_from_rollup,
    merge_rollups,
    merge_weather_codes,
    rollup,
    weather_codes_from_rollup,
)
from skyledger.operators.silver import to_silver
from skyledger.plans.ledger import ingest_new
from skyledger.plans.storage import (
    MARKS_PER_BLOCK,
    MERGED_ROLLUP,
    REFRESH_MARK,
    TOUCHED_DAYS,
    WEATHER_CODES,
    Deployment,
    block_of,
    has_folder,
)
from skyledger.sinks.catalog import switch_catalogs
from skyledger.sinks.tables import LoadMetrics, write_load
from skyledger.sources.commits import if_there, marks_above, valid_loads
from skyledger.sources.raw import RAW_GLOB, read_raw
from skyledger.sources.schema import CORRUPT, LOCAL_DAY, silver_schema
from skyledger.sources.tables import (
    is_half_written,
    last_refresh,
    renew_views,
    rollups_of,
    stored_gold,
)
from skyledger.streaming.ingest import ingest_available, start_ingest


def build_gold(silver: DataFrame) -> dict[str, DataFrame]:
    """All seven gold tables of a silver frame over one rollup, lazily.

    Each table read alone computes that rollup again; ``refresh_gold`` stores it.
    """
    states = rollup(silver)
    tables = daily_tables(daily_wide_from_rollup(states))
    return {**tables, "weather_condition_summary": weather_codes_from_rollup(states)}


def _in_days(day: str, days: list) -> Column:
    """A filter by partition values, so that only the files of these days are opened."""
    known = [d for d in days if d is not None]
    found = F.col(day).isin(known) if known else F.lit(False)
    return found | F.col(day).isNull() if len(known) < len(days) else found


def _merged_blocks(spark: SparkSession, deployment: Deployment) -> set[int]:
    marks = if_there(spark, lambda: spark.read.schema("block bigint").json(deployment.merged_marks))
    return set() if marks is None else {row[0] for row in marks.collect()}


def _rollups(spark: SparkSession, deployment: Deployment, blocks: list[int]) -> DataFrame | None:
    """Rollups of the loads of some blocks, in one scan, with ``load`` and ``block``."""
    there = [p for p in map(deployment.rollups, blocks) if has_folder(spark, p)]
    reader = spark.read.option("basePath", deployment.rollup)
    return reader.parquet(*there) if there else None


def _new_states(
    spark: SparkSession,
    deployment: Deployment,
    marks: DataFrame,
    blocks: range,
    merged: set[int] = frozenset(),
) -> DataFrame:
    """Rollup rows of the loads that count among the marks, which lie in the blocks.

    Of blocks that are ``merged`` the one merged rollup is read, without the rows of streams that
    were superseded since. However many loads there are, that is two scans.
    """
    frames = []
    rollups = _rollups(spark, deployment, [b for b in blocks if b not in merged])
    if rollups is not None:
        frames.append(rollups_of(rollups, valid_loads(marks)).drop("block"))
    if closed := [f"{deployment.merged_blocks}/block={b}" for b in blocks if b in merged]:
        reader = spark.read.option("basePath", deployment.merged_blocks)
        gone = marks.where("supersedes is not null").select(F.col("supersedes").alias("stream"))
        kept = reader.parquet(*closed).join(gone.distinct(), "stream", "left_anti")
        frames.append(kept.drop("stream", "block"))
    if not frames:
        return rollup(spark.createDataFrame([], silver_schema()))
    return reduce(DataFrame.unionByName, frames)


def merge_closed_blocks(spark: SparkSession, deployment: Deployment, number: int) -> None:
    """Merge the rollups of every block of loads that ends at or below ``number`` into one.

    Rows stay apart by the stream of their load, so that one can still be left out. The mark of a block comes
    after its files; without it the loads' own rollups count.
    """
    done = _merged_blocks(spark, deployment)
    for block in range(block_of(number + 1)):
        if block in done or (rollups := _rollups(spark, deployment, [block])) is None:
            continue
        marks = marks_above(spark, deployment, block * MARKS_PER_BLOCK - 1)
        loads = marks.where(F.col("load").isNotNull() & (F.col("block") == block))
        typed = rollups.withColumn("load", F.col("load").cast("string")).drop("block")
        rows = typed.join(loads.select("load", "stream").distinct(), "load").drop("load")
        target = f"{deployment.merged_blocks}/block={block}"
        merge_rollups(rows, "stream").write.mode("overwrite").parquet(target)
        mark = spark.createDataFrame([(block,)], "block bigint").coalesce(1)
        mark.write.mode("append").json(deployment.merged_marks)


def refresh_gold(spark: SparkSession, deployment: Deployment, from_all_loads: bool = False) -> int:
    """Bring the gold tables up to date in the idle slot, then make that slot current.

    Only days of loads that were committed since the last refresh are merged and written, with the
    days of the refresh before, which the idle slot has not seen. Other days of the slot stay as
    they are, and the weather codes are the counts so far plus those of the new loads. Without a new
    load nothing is written. ``from_all_loads`` starts over; so does a refresh after loads were
    superseded, and the refresh after such a one writes the other slot whole.

    Writing the slot's mark comes last and switches all tables at once; a refresh that dies half-way
    leaves the current slot alone, and the next one writes the same days again. There must be one
    refresh at a time; a reader has until the end of the next refresh to finish with the slot it
    opened. The days touched pass through the driver; they are as many as the calendar has. Views
    in catalogs follow; blocks of loads that are full are merged for the next rebuild.
    """
    newest = last_refresh(spark, deployment)
    marks = marks_above(spark, deployment, -1 if newest is None else newest["merged"])
    seen = marks.agg(
        F.max("number").alias("number"), F.count("supersedes").alias("superseding")
    ).first()
    if newest is not None and seen["number"] is None and not from_all_loads:
        return newest["refresh"]
    rebuild = newest is None or from_all_loads or seen["superseding"] > 0
    merged = newest["merged"] if seen["number"] is None else seen["number"]
    merged = -1 if merged is None else merged
    number, slot = (0, 0) if newest is None else (newest["refresh"] + 1, 1 - newest["slot"])
    above = -1
    if rebuild:
        marks = marks_above(spark, deployment, above)
    else:
        above = newest["merged"]
    blocks = range(block_of(max(above, 0)), block_of(max(merged, 0)) + 1)
    closed = _merged_blocks(spark, deployment) if rebuild else frozenset()
    states = _new_states(spark, deployment, marks, blocks, closed)
    touched = [row[0] for row in states.select(LOCAL_DAY).distinct().collect()]
    whole = rebuild or newest["rebuilt"] or is_half_written(spark, deployment, slot)

    def current(table: str) -> DataFrame:
        return spark.read.parquet(deployment.gold(newest["slot"], table))

    def mark(refresh: int) -> None:
        row = spark.range(1).select(
            F.lit(refresh).cast("bigint").alias("refresh"),
            F.lit(slot).alias("slot"),
            F.lit(merged).cast("bigint").alias("merged"),
            F.lit(rebuild).alias("rebuilt"),
            F.current_timestamp().alias("refreshed_at"),
        )
        row.coalesce(1).write.mode("overwrite").json(deployment.gold(slot, REFRESH_MARK))

    def write(name: str, table: DataFrame, day: str | None = None) -> DataFrame:
        folder = deployment.gold(slot, name)
        writer = table.write.mode("overwrite")
        if day is not None:
            mode = "static" if whole else "dynamic"
            writer = writer.option("partitionOverwriteMode", mode).partitionBy(day)
        writer.parquet(folder)
        return spark.read.schema(table.schema).parquet(folder)

    if whole:
        mark(-1)
    codes = weather_codes_from_rollup(states)
    days = touched
    if not rebuild:
        codes = merge_weather_codes(current(WEATHER_CODES).unionByName(codes))
        before = stored_gold(spark, deployment, newest["slot"], MERGED_ROLLUP)
        if not whole:
            earlier = [row[0] for row in current(TOUCHED_DAYS).collect()]
            days = list({*touched, *earlier})
            before = before.where(_in_days(LOCAL_DAY, days))
        states = before.unionByName(states)
    by_day = merge_rollups(states).hint("rebalance", LOCAL_DAY)
    stored = write(MERGED_ROLLUP, by_day, LOCAL_DAY)
    if not whole:
        stored = stored.where(_in_days(LOCAL_DAY, days))
    wide = daily_wide_from_rollup(stored).hint("rebalance", "date")
    touched_rows = spark.createDataFrame([(day,) for day in touched], f"{LOCAL_DAY} date")
    # Independent small jobs: none of them fills a cluster, so they share it.
    work = [(DAILY_WIDE, wide, "date"), (WEATHER_CODES, codes, None), (TOUCHED_DAYS, touched_rows, None)]
    with ThreadPoolExecutor(len(work)) as pool:
        list(pool.map(inheritable_thread_target(spark)(lambda item: write(*item)), work))

    mark(number)
    renew_views(spark, deployment)
    switch_catalogs(spark, deployment)
    merge_closed_blocks(spark, deployment, merged)
    return number


def append_all(
    spark: SparkSession,
    deployment: Deployment,
    raw: str | None = None,
    glob: str = RAW_GLOB,
    recursive: bool = False,
    location_mode: str = "string",
    gather_days: bool = False,
) -> LoadMetrics:
    """Read the whole raw zone and append it to silver, also what earlier runs already appended.

    Every call is a new load; calling it again after a failure appends again.
    """
    documents = read_raw(spark, raw or deployment.raw, glob, recursive)
    silver = to_silver(documents, location_mode, keep=[CORRUPT])
    return write_load(silver, deployment, f"run-{uuid.uuid4().hex}", gather_days)


def run(
    spark: SparkSession,
    deployment: Deployment,
    raw: str | None = None,
    mode: str = "incremental",
    **reading: object,
) -> int:
    """One periodic run: raw to silver, then, when that is done, silver to gold.

    ``incremental`` takes each raw file once, as a stream; ``ledger`` does so without state that
    grows on the driver, for deployments that run for years; ``append_full`` appends the whole raw zone on every
    run, so that repeated runs count their records repeatedly.
    """
    if mode == "incremental":
        ingest_available(spark, deployment, raw, **reading)
    elif mode == "ledger":
        ingest_new(spark, deployment, raw, **reading)
    elif mode == "append_full":
        append_all(spark, deployment, raw, **reading)
    else:
        raise ValueError(f"mode must be 'incremental', 'ledger' or 'append_full', not {mode!r}")
    return refresh_gold(spark, deployment)


def run_every(
    spark: SparkSession,
    deployment: Deployment,
    every: str = "1 hour",
    raw: str | None = None,
    **reading: object,
) -> StreamingQuery:
    """Periodic runs in one stream: new raw files to silver, then a gold refresh, never two at once.

    A period without new files does nothing.
    """
    return start_ingest(
        spark,
        deployment,
        raw,
        every=every,
        after_load=lambda: refresh_gold(spark, deployment),
        **reading,
    )
