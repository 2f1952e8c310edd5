"""Every operator as a query over the ``events`` table of a data folder.

Documents are derived from all events. Queries about reading, landing and streaming go through JSON
text or files in a scratch folder; the others start at the flat fields, so that Catalyst prunes the
scan and the derivation down to what a query needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.operators import alerts, gold
from skyledger.operators.silver import to_silver, typed_silver
from skyledger.plans import refresh
from skyledger.plans.compaction import compact, remove_replaced
from skyledger.plans.ledger import ingest_new
from skyledger.plans.storage import Deployment, load_folder, scratch_folder, shuffles_removed
from skyledger.sinks.catalog import publish_catalog
from skyledger.sinks.tables import land_documents, land_lines
from skyledger.sources import envelope
from skyledger.sources.raw import parse_documents, read_raw, to_lines, well_formed
from skyledger.sources.sample_documents import (
    events_table,
    weather_documents,
    weather_fields,
)
from skyledger.sources.schema import (
    CORRUPT,
    EVENT_COLUMNS,
    LOCAL_DAY,
    LOCATION_KEY,
    MEASUREMENTS,
    STATUS,
    STATUS_OK,
    TEXT_LINE,
    snake_case,
)
from skyledger.sources.tables import read_all_gold, read_gold, read_silver
from skyledger.streaming.alerts import digests_of, publish_once, undecoded_of, write_digests
from skyledger.streaming.ingest import ingest_available

Query = Callable[[SparkSession, str], DataFrame]

FIRST_DAY = date(2024, 1, 31)
SECOND_DAY = date(2024, 2, 1)
ENVELOPES_PER_FILE = 200_000


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_documents(events_table(spark, sf_dir))


def _spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over all cores: an event is a few bytes in one file split, its JSON text many that
    are written and parsed. Not for landing, where a task writes a file per day."""
    events = events_table(spark, sf_dir)
    return weather_documents(events.repartition(spark.sparkContext.defaultParallelism))


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_fields(events_table(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    return typed_silver(_fields(spark, sf_dir), **options)


def _new_deployment(spark: SparkSession, label: str) -> Deployment:
    return Deployment(scratch_folder(spark, label))


def _landed(spark: SparkSession, sf_dir: str, label: str) -> Deployment:
    deployment = _new_deployment(spark, label)
    land_documents(_documents(spark, sf_dir), deployment.raw, FIRST_DAY)
    return deployment


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every document as a JSON line and read the raw zone back, values as text."""
    documents = well_formed(read_raw(spark, _landed(spark, sf_dir, "raw").raw))
    return documents.select(
        F.col("data.time").alias("time"),
        "location.name",
        "location.lat",
        "location.lon",
        *(F.col(f"data.values.{m}").alias(snake_case(m)) for m in MEASUREMENTS),
    )


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per event: some without records, some with a second, unreadable record."""
    lines = to_lines(_spread_documents(spark, sf_dir), keep=("event_id",))
    text, event_id = F.col(TEXT_LINE), F.col("event_id")

    def record(data: Column) -> Column:
        return F.struct(F.struct(data.alias("data")).alias("kinesis"))

    good = record(envelope.encode_payload(text))
    cut_short = record(envelope.encode_payload(F.substring(text, 1, 60)))
    not_base64 = record(F.concat(F.lit("*"), envelope.encode_payload(text)))
    records = (
        F.when(event_id % 40 == 0, F.lit(None))
        .when(event_id % 41 == 0, F.array(good, cut_short))
        .when(event_id % 43 == 0, F.array(not_base64, good))
        .otherwise(F.array(good))
    )
    return lines.select("event_id", F.to_json(F.struct(records.alias("Records"))).alias(TEXT_LINE))


def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = envelope.decode_envelopes(_envelopes(spark, sf_dir), keep=["event_id"])
    is_good = F.col("decode_error").isNull()
    return records.select(
        "event_id",
        F.col("record_index").cast("int").alias("record_index"),
        "decode_error",
        F.when(is_good, F.col("data.time")).alias("time"),
        F.when(is_good, F.col("location.name")).alias("name"),
        F.when(is_good, F.col("data.values.windGust")).alias("wind_gust"),
        F.when(is_good, F.col("data.values.temperature")).alias("temperature"),
    )


def envelope_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.envelope_status(_envelopes(spark, sf_dir), keep=["event_id"])


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text to silver; the ingestion columns depend on the clock and are left out."""
    lines = to_lines(_spread_documents(spark, sf_dir))
    return to_silver(well_formed(parse_documents(lines))).select(*EVENT_COLUMNS)


def silver_location_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily temperature when the location name is cast to double, which leaves it NULL."""
    silver = _silver(spark, sf_dir, location_mode="double")
    return gold.gold_table(silver, "avg_temperature_daily")


def silver_local_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, keep=["event_id"]).select(
        "event_id", "datetime_utc", "datetime_brasil"
    )


def _gold_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold.gold_table(_silver(spark, sf_dir), name)

    query.__name__ = name
    return query


def _ordered_gold_query(name: str) -> Query:
    """The table in reading order, each row with its position there."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ordered = gold.gold_table(_silver(spark, sf_dir), name, ordered=True)
        folder = f"{scratch_folder(spark, 'ordered')}/{name}"
        gold.numbered(ordered).write.parquet(folder)
        return gold.with_position(spark.read.parquet(folder))

    query.__name__ = f"{name}_ordered"
    return query


def gold_fused_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_wide(_silver(spark, sf_dir))


def gold_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide daily table out of mergeable partial states."""
    return gold.daily_wide_from_rollup(gold.rollup(_silver(spark, sf_dir)))


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_inputs(_fields(spark, sf_dir), keep=["event_id"])


def alert_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = [snake_case(m) for m in alerts.DEFAULTS]
    texts = [f"{number}_text" for number in numbers]
    return _inputs(spark, sf_dir).select("event_id", "label", *numbers, *texts)


def location_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.location_labels(_fields(spark, sf_dir), keep=["event_id"])


def alert_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.fired_rules(_inputs(spark, sf_dir), keep=["event_id"])


def alert_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_digests(_inputs(spark, sf_dir), keep=["event_id", "label"])


def alert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_summary(_inputs(spark, sf_dir))


def silver_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two full appends of one raw zone: every record is there twice."""
    deployment = _landed(spark, sf_dir, "append")
    for _ in range(2):
        refresh.append_all(spark, deployment)
    silver = read_silver(spark, deployment)
    day = F.col("datetime_brasil").alias("date")
    return silver.groupBy(*LOCATION_KEY, day).agg(F.count(F.lit(1)).alias("rows"))


def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append, refresh all gold tables, and stack what the current slot holds."""
    deployment = _landed(spark, sf_dir, "gold")
    refresh.run(spark, deployment, mode="append_full")
    return _all_gold(spark, deployment)


def _all_gold(spark: SparkSession, deployment: Deployment) -> DataFrame:
    tables = read_all_gold(spark, deployment).items()
    return reduce(DataFrame.unionByName, (gold.in_long_form(*table) for table in tables))


def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that one load reports; some landed lines are cut short."""
    deployment = _new_deployment(spark, "metrics")
    lines = to_lines(_documents(spark, sf_dir), keep=("event_id",))
    text = F.col(TEXT_LINE)
    spoilt = F.when(F.col("event_id") % 101 == 0, F.substring(text, 1, 60)).otherwise(text)
    land_lines(lines.select(spoilt.alias(TEXT_LINE)), deployment.raw, FIRST_DAY)
    metrics = refresh.append_all(spark, deployment, gather_days=False)
    return spark.createDataFrame(
        [(metrics.rows_read, metrics.rows_corrupt, metrics.rows_written)],
        "rows_read bigint, rows_corrupt bigint, rows_written bigint",
    )


def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings and three runs over one checkpoint: each file arrives once."""
    deployment = _new_deployment(spark, "stream")
    documents = _documents(spark, sf_dir)
    later = F.col("event_id") % 3 == 0
    land_documents(documents.where(~later), deployment.raw, FIRST_DAY)
    ingest_available(spark, deployment)
    land_documents(documents.where(later), deployment.raw, SECOND_DAY)
    ingest_available(spark, deployment)
    ingest_available(spark, deployment)
    return read_silver(spark, deployment).select(*EVENT_COLUMNS)


def silver_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five loads, compactions after the second, the fourth and the last, and what they replaced
    removed: every record is there once."""
    deployment = _new_deployment(spark, "compacted")
    documents = _documents(spark, sf_dir)
    for part in range(5):
        raw = f"{deployment.root}/landing-{part}"
        land_documents(documents.where(F.col("event_id") % 5 == part), raw, FIRST_DAY)
        refresh.append_all(spark, deployment, raw)
        if part % 2:
            compact(spark, deployment)
    compact(spark, deployment, least_loads=1)
    remove_replaced(spark, deployment)
    return read_silver(spark, deployment).select(*EVENT_COLUMNS)


def means_of_six_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of values with six decimals, from rollups of parts merged in no order."""
    millionths = "cast((event_id * {}) % {} as double) / cast(1000000 as double)"
    fields = _fields(spark, sf_dir).withColumns(
        {
            "temperature": F.expr(millionths.format(7919, 60_000_000)),
            "humidity": F.expr(f"-({millionths.format(104_729, 999_983)})"),
        }
    )
    silver = typed_silver(fields, keep=["event_id"])
    parts = (gold.rollup(silver.where(F.col("event_id") % 3 == part)) for part in range(3))
    daily = gold.daily_wide_from_rollup(reduce(DataFrame.unionByName, parts))
    return daily.select(*LOCATION_KEY, "date", "avg_temperature", "avg_humidity")


def alerts_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests through the outbox, the same envelopes twice in it and the whole stream once more with a
    lost checkpoint: what was sent, each digest once."""
    folder = scratch_folder(spark, "outbox")
    envelopes = _envelopes(spark, sf_dir).select(TEXT_LINE)
    # compressed they take an eighth of the disk, in files that one task each can read
    packed = {"compression": "gzip", "maxRecordsPerFile": ENVELOPES_PER_FILE}
    with shuffles_removed(spark):
        for _ in range(2):
            envelopes.write.mode("append").options(**packed).text(f"{folder}/envelopes")

    def send(digests: DataFrame, number: int) -> None:
        digests.write.mode("append").option("compression", "zstd").parquet(f"{folder}/received")

    for checkpoint in ("first", "second"):
        digests = digests_of(envelope.stream_envelopes(spark, f"{folder}/envelopes"))
        query = publish_once(digests, send, f"{folder}/outbox", f"{folder}/{checkpoint}")
        query.awaitTermination()
    received = spark.read.parquet(f"{folder}/received")
    return received.select("datetime_utc", "location_name", "label", "subject", "message")


def silver_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landings in new and in old folders between runs over the ledger: each file arrives once."""
    deployment = _new_deployment(spark, "ledger")
    documents = _documents(spark, sf_dir)
    for part, day in enumerate((SECOND_DAY, FIRST_DAY, SECOND_DAY)):
        land_documents(documents.where(F.col("event_id") % 3 == part), deployment.raw, day)
        ingest_new(spark, deployment)
    ingest_new(spark, deployment)
    return read_silver(spark, deployment).select(*EVENT_COLUMNS)


def gold_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold tables as another session finds them by name after each of three refreshes."""
    deployment = _new_deployment(spark, "catalog")
    database = f"weather_{uuid.uuid4().hex}"
    spark.sql(f"create database {database} location '{scratch_folder(spark, 'database')}'")
    documents = _documents(spark, sf_dir)
    other, totals = spark.newSession(), []
    for part in range(3):
        land_documents(documents.where(F.col("event_id") % 3 == part), deployment.raw, FIRST_DAY)
        refresh.run(spark, deployment)
        if part == 0:
            publish_catalog(spark, deployment, database)
        codes = other.table(f"{database}.weather_condition_summary")
        totals.append(codes.agg(F.sum("weather_code_count")).first()[0])
    seen = [gold.in_long_form(name, other.table(f"{database}.{name}")) for name in gold.GOLD_TABLES]
    counts = spark.createDataFrame(list(enumerate(totals)), "part int, total bigint")
    as_rows = counts.select(
        F.concat(F.lit("refresh "), "part").alias("table_name"),
        F.lit(None).cast("string").alias("location_name"),
        *(F.lit(None).cast("double").alias(c) for c in ("latitude", "longitude")),
        F.lit(None).cast("date").alias("date"),
        F.lit(None).cast("int").alias("weather_code"),
        F.lit("weather_code_count").alias("measure"),
        F.col("total").cast("double").alias("value"),
    )
    folder = scratch_folder(spark, "catalog-rows")
    for number, frame in enumerate((*seen, as_rows)):
        frame.write.parquet(f"{folder}/part={number}")
    return spark.read.parquet(folder).drop("part")


#: What stands behind a document on a line, by event: brackets that a careless reader takes for its own.
STRAY_BRACKETS = ("", "]} [ {", '],"b":[{}', " }", "]}")


def raw_stray_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents followed by stray brackets are no documents."""
    lines = to_lines(_spread_documents(spark, sf_dir), keep=("event_id",))
    stray = F.get(F.array(*map(F.lit, STRAY_BRACKETS)), F.col("event_id") % len(STRAY_BRACKETS))
    behind = lines.select("event_id", F.concat(TEXT_LINE, stray).alias(TEXT_LINE))
    parsed = parse_documents(behind, keep=["event_id"])
    is_good = F.col(CORRUPT).isNull()
    return parsed.select(
        "event_id",
        F.when(is_good, F.col("data.time")).alias("time"),
        F.when(is_good, F.col("location.name")).alias("name"),
        F.right(CORRUPT, F.lit(4)).alias("corrupt_end"),
    )


INGESTED_AT = datetime(2024, 2, 3, 12, 5, 6)


def silver_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ingestion columns for a given moment: noon in UTC, so one day for most session zones."""
    moment = F.lit(f"{INGESTED_AT:%Y-%m-%d %H:%M:%S}Z").cast("timestamp")
    silver = _silver(spark, sf_dir, keep=["event_id"], ingested_at=moment)
    return silver.select(
        "event_id",
        "ingestion_at",
        F.unix_seconds("ingestion_at_timestamp").alias("ingestion_seconds"),
    )


CUSTOM_THRESHOLDS = {
    "PRECIPITATION_PROBABILITY_THRESHOLD": "55",
    "WIND_SPEED_THRESHOLD": "12.5",
    "LOW_TEMP_THRESHOLD": "0.5",
    "LOW_VISIBILITY_THRESHOLD": "2.25",
}


def alert_rules_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fired rules with some thresholds from a mapping; a missing temperature counts as 0 and fires."""
    config = alerts.AlertConfig.from_environment(CUSTOM_THRESHOLDS)
    inputs = alerts.alert_inputs(_fields(spark, sf_dir), config, keep=["event_id"])
    return alerts.fired_rules(inputs, config, keep=["event_id"])


def raw_joined_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land lines with three documents each, some with junk behind the last, and read them back:
    documents, and the pieces that could not be read."""
    deployment = _new_deployment(spark, "joined")
    lines = to_lines(_documents(spark, sf_dir), keep=("event_id",))
    spoilt = F.when(F.col("event_id") % 30 == 29, F.lit(" }junk")).otherwise(F.lit(""))
    line = F.floor(F.col("event_id") / 3).alias("line")
    rows = lines.select(line, "event_id", F.concat(TEXT_LINE, spoilt).alias("piece"))
    joined = rows.groupBy("line").agg(F.sort_array(F.collect_list(F.struct("event_id", "piece"))).alias("p"))
    joined = joined.select(F.concat_ws(" ", F.col("p.piece")).alias(TEXT_LINE))
    land_lines(joined, deployment.raw, FIRST_DAY)
    raw = read_raw(spark, deployment.raw)
    return raw.select(
        F.when(F.col(CORRUPT).isNull(), F.col("data.time")).alias("time"),
        F.when(F.col(CORRUPT).isNull(), F.col("location.name")).alias("name"),
        F.when(F.col(CORRUPT).isNull(), F.col("data.values.windGust")).alias("wind_gust"),
        F.right(CORRUPT, F.lit(7)).alias("corrupt_end"),
        F.regexp_extract(CORRUPT, r'"time":"([^"]*)"', 1).alias("corrupt_time"),
    )


def silver_after_failed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that failed after its rows were written, then the same input again: it counts once."""
    deployment = _landed(spark, sf_dir, "failed")
    documents = to_silver(read_raw(spark, deployment.raw), keep=[CORRUPT])
    half = documents.withColumn(STATUS, F.lit(STATUS_OK))
    half.write.partitionBy(STATUS, LOCAL_DAY).parquet(load_folder(deployment.silver, "failed"))
    refresh.run(spark, deployment, mode="append_full")
    silver = read_silver(spark, deployment)
    day = F.col(LOCAL_DAY).alias("date")
    in_silver = silver.groupBy(*LOCATION_KEY, day).agg(F.count(F.lit(1)).alias("rows"))
    in_gold = read_gold(spark, deployment, "snow_rain_condition_daily")
    return in_silver.join(
        in_gold.withColumnsRenamed({c: f"gold_{c}" for c in (*LOCATION_KEY, "date")}),
        [F.col(c).eqNullSafe(F.col(f"gold_{c}")) for c in (*LOCATION_KEY, "date")],
        "full",
    ).select(*LOCATION_KEY, "date", "rows", "rain_events", "snow_events")


def _odd_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per event and line: some broken, some of another shape, some with a payload of
    two documents, some followed by a second envelope."""
    lines = to_lines(_spread_documents(spark, sf_dir), keep=("event_id",))
    text, event_id = F.col(TEXT_LINE), F.col("event_id")

    def whole(payload: Column) -> Column:
        record = F.struct(F.struct(envelope.encode_payload(payload).alias("data")).alias("kinesis"))
        return F.to_json(F.struct(F.array(record).alias("Records")))

    good = whole(text)
    line = (
        F.when(event_id % 7 == 0, F.substring(good, 1, 40))
        .when(event_id % 7 == 1, F.lit('{"Records": 5}'))
        .when(event_id % 7 == 2, whole(F.concat(text, text)))
        .when(event_id % 7 == 3, F.concat(good, F.lit(" "), good))
        .otherwise(good)
    )
    return lines.select("event_id", line.alias(TEXT_LINE))


def envelope_oddities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and errors out of joined, broken and wrongly typed envelopes."""
    records = envelope.decode_envelopes(_odd_envelopes(spark, sf_dir), keep=["event_id"])
    return records.select(
        "event_id",
        F.col("record_index").cast("int").alias("record_index"),
        F.col("document_index").cast("int").alias("document_index"),
        "decode_error",
        F.col("data.time").alias("time"),
    )


def envelope_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.envelope_status(_odd_envelopes(spark, sf_dir), keep=["event_id"])


def alerts_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the alert stream sets aside of odd envelopes."""
    folder = scratch_folder(spark, "aside")
    _odd_envelopes(spark, sf_dir).select(TEXT_LINE).write.text(f"{folder}/envelopes")
    bad = undecoded_of(envelope.stream_envelopes(spark, f"{folder}/envelopes"))
    write_digests(bad, f"{folder}/bad", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/bad").select("decode_error", "bad_payload")


def alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope files through the alert stream, then the digests it wrote."""
    folder = scratch_folder(spark, "alerts")
    envelopes = _envelopes(spark, sf_dir).select(TEXT_LINE)
    envelopes.write.text(f"{folder}/envelopes")
    digests = digests_of(envelope.stream_envelopes(spark, f"{folder}/envelopes"))
    write_digests(digests, f"{folder}/digests", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/digests")


def raw_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two periodic runs, the second over one more landing; rows of every table afterwards."""
    deployment = _new_deployment(spark, "run")
    documents = _documents(spark, sf_dir)
    later = F.col("event_id") % 4 == 1
    land_documents(documents.where(~later), deployment.raw, FIRST_DAY)
    refresh.run(spark, deployment)
    land_documents(documents.where(later), deployment.raw, SECOND_DAY)
    refresh.run(spark, deployment)
    return _all_gold(spark, deployment)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        raw_events,
        envelope_decode,
        envelope_status,
        silver_events,
        silver_location_double,
        silver_local_day,
        silver_ingestion,
        raw_joined_objects,
        silver_after_failed_load,
        envelope_oddities,
        envelope_reasons,
        alerts_quarantine,
        *(_gold_query(name) for name in gold.GOLD_TABLES),
        *(_ordered_gold_query(name) for name in gold.GOLD_TABLES),
        gold_fused_daily,
        gold_from_rollup,
        alert_inputs,
        location_label,
        alert_rules,
        alert_rules_custom,
        alert_digests,
        alert_summary,
        silver_append_twice,
        gold_refresh,
        ingest_metrics,
        silver_compacted,
        silver_ledger,
        gold_catalog,
        raw_stray_brackets,
        silver_stream,
        alerts_stream,
        alerts_outbox,
        means_of_six_decimals,
        raw_to_gold,
    )
}
