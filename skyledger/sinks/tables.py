"""Writers: raw landing zone, silver loads with their rollup, relational tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.operators.gold import rollup
from skyledger.plans.storage import Deployment, block_of, load_folder
from skyledger.sources.commits import MARK_SCHEMA, last_block
from skyledger.sources.envelope import to_envelopes
from skyledger.sources.raw import to_lines
from skyledger.sources.schema import (
    CORRUPT,
    LOCAL_DAY,
    SILVER_COLUMNS,
    STATUS,
    STATUS_CORRUPT,
    STATUS_OK,
    TEXT_LINE,
)
from skyledger.sources.tables import last_refresh, read_load


@dataclass(frozen=True)
class LoadMetrics:
    rows_read: int
    rows_corrupt: int
    rows_written: int


def land_lines(lines: DataFrame, raw: str, day: date) -> None:
    """Append JSON texts to the folder of the landing day, three levels below ``raw``.

    Rows stay in the partitions they are in: nothing is keyed, so nothing can
    pile up on one key.
    """
    lines.select(TEXT_LINE).write.mode("append").text(f"{raw}/{day:%Y/%m/%d}")


def land_documents(documents: DataFrame, raw: str, day: date) -> None:
    land_lines(to_lines(documents), raw, day)


def send_documents(
    documents: DataFrame, path: str | None = None, format: str = "text", **options: str
) -> None:
    """Append documents to a stream, one envelope each.

    Text files take the envelope alone. Any other format also gets a ``key``, the location, so that
    the stream spreads over its partitions.
    """
    envelopes = to_envelopes(documents, keep=["location"])
    columns = [TEXT_LINE]
    if format != "text":
        columns = [F.col("location.name").cast("string").alias("key"), *columns]
    envelopes.select(*columns).write.format(format).options(**options).mode("append").save(path)


def _by_day(silver: DataFrame) -> DataFrame:
    """Gather the rows of a day for fewer, larger files.

    Adaptive execution cuts a large day into several tasks, so a day with most of the rows is no
    hot spot; without adaptive execution it would be one, and the rows stay where they are.
    """
    adaptive = silver.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return silver.hint("rebalance", LOCAL_DAY) if adaptive else silver


@dataclass(frozen=True)
class _Place:
    """The number that a load gets, and whether it has been committed already."""

    number: int
    committed: bool


def _next_place(spark: SparkSession, deployment: Deployment, load_id: str | None) -> _Place:
    refreshed = last_refresh(spark, deployment)
    first = 0 if refreshed is None else block_of(max(refreshed["merged"], 0))
    marks = last_block(spark, deployment, first)
    if marks is None:
        return _Place(0, False)
    known = marks.agg(
        F.max("number").alias("number"), F.max(F.col("load") == load_id).alias("committed")
    ).first()
    return _Place(known["number"] + 1, bool(known["committed"]))


def next_number(spark: SparkSession, deployment: Deployment) -> int:
    """The number that the next mark gets."""
    return _next_place(spark, deployment, None).number


def _mark(
    spark: SparkSession,
    deployment: Deployment,
    number: int,
    load: str | None,
    stream: str | None,
    supersedes: str | None = None,
) -> None:
    mark = spark.createDataFrame(
        [(number, block_of(number), load, stream, supersedes)], MARK_SCHEMA
    )
    mark.coalesce(1).write.mode("append").json(deployment.commits(block_of(number)))


def supersede(spark: SparkSession, deployment: Deployment, old: str, stream: str) -> None:
    """From now on the loads of the stream ``old`` do not count."""
    place = _next_place(spark, deployment, None)
    _mark(spark, deployment, place.number, None, stream, old)


def write_load(
    silver: DataFrame,
    deployment: Deployment,
    load_id: str,
    gather_days: bool = False,
    stream: str | None = None,
    count: bool = True,
) -> LoadMetrics | None:
    """Write one load of silver rows (with ``_corrupt_record`` kept), then its rollup, then its mark.

    One pass over the input: pieces that could not be read go to a partition of their own in the
    same write. The rollup reads the columns it needs from the files just written. A load that has
    its mark already, such as the last batch of a stream that is repeated, is left as it is.

    The counts come from the footers of the files written: unlike counters that ride along with the
    write, they stay right when a lost executor makes Spark repeat tasks. ``count`` False saves the
    job. ``gather_days`` shuffles the rows by local day, for input that arrives in
    another order.
    """
    spark = silver.sparkSession
    place = _next_place(spark, deployment, load_id)
    stored = silver.drop(CORRUPT).schema
    if not place.committed:
        status = F.when(F.col(CORRUPT).isNotNull(), STATUS_CORRUPT).otherwise(STATUS_OK)
        rows = silver.withColumn(STATUS, status)
        arranged = _by_day(rows) if gather_days else rows
        target = load_folder(deployment.silver, load_id)
        arranged.write.mode("overwrite").partitionBy(STATUS, LOCAL_DAY).parquet(target)
        good = read_load(spark, deployment, load_id, stored, STATUS_OK)
        folder = load_folder(deployment.rollups(block_of(place.number)), load_id)
        rollup(good.select(*SILVER_COLUMNS)).write.mode("overwrite").parquet(folder)
        _mark(spark, deployment, place.number, load_id, stream)
    if not count:
        return None
    written = read_load(spark, deployment, load_id, stored, STATUS_OK)
    corrupt = read_load(spark, deployment, load_id, stored, STATUS_CORRUPT)
    by_status = {
        status: frame.select(F.count(F.lit(1))).first()[0]
        for status, frame in ((STATUS_OK, written), (STATUS_CORRUPT, corrupt))
    }
    return LoadMetrics(
        rows_read=sum(by_status.values()),
        rows_corrupt=by_status[STATUS_CORRUPT],
        rows_written=by_status[STATUS_OK],
    )


def append_jdbc(
    silver: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    connections: int = 16,
) -> None:
    """Append silver rows to a relational table over at most ``connections`` connections."""
    writer = silver.select(*SILVER_COLUMNS).write.option("numPartitions", connections)
    writer.jdbc(url, table, mode="append", properties=properties)


def replace_jdbc(
    gold: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    connections: int = 16,
) -> None:
    """Drop and create a relational gold table over at most ``connections`` connections."""
    writer = gold.write.option("numPartitions", connections)
    writer.jdbc(url, table, mode="overwrite", properties=properties)


def replace_catalog_table(gold: DataFrame, table: str) -> None:
    """Drop and create a table of the session catalog."""
    gold.write.mode("overwrite").saveAsTable(table)
