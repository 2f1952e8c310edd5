"""Readers of the silver, rollup and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from skyledger.operators.gold import (
    DAILY_WIDE,
    GOLD_TABLES,
    daily_columns,
    daily_wide,
    order_for_reading,
    rollup,
)
from skyledger.plans.storage import REFRESH_MARK, WEATHER_CODES, Deployment, load_folder
from skyledger.sources.commits import Source, committed_loads, if_there, silver_sources
from skyledger.sources.schema import (
    CORRUPT,
    INGESTION_COLUMNS,
    ORIGIN_STREAM,
    SILVER_COLUMNS,
    STATUS,
    STATUS_CORRUPT,
    STATUS_OK,
    silver_schema,
)

_REFRESH_SCHEMA = (
    "refresh bigint, slot int, merged bigint, rebuilt boolean, refreshed_at timestamp"
)
_LOAD = "load"


def _silver_files(
    spark: SparkSession,
    paths: list[str],
    location_mode: str,
    schema: T.StructType | None,
    *more: str,
    **options: str,
) -> DataFrame:
    columns = (schema or silver_schema(location_mode)).fields
    texts = [T.StructField(name, T.StringType()) for name in (CORRUPT, ORIGIN_STREAM, *more, STATUS)]
    return spark.read.schema(T.StructType([*columns, *texts])).options(**options).parquet(*paths)


def silver_of_sources(
    spark: SparkSession,
    deployment: Deployment,
    location_mode: str,
    sources: list[Source],
    gone: list[str],
) -> DataFrame:
    """Silver files of some folders, with ``load``, ``status``, ``_corrupt_record`` and, for compacted
    ones, ``origin_stream``, and without the rows of streams that are ``gone``. No other folder is
    listed."""
    paths = [load_folder(deployment.silver, s.load) for s in sources]
    if not paths:
        columns = [*silver_schema(location_mode)]
        columns += [T.StructField(c, T.StringType()) for c in (CORRUPT, ORIGIN_STREAM, _LOAD, STATUS)]
        return spark.createDataFrame([], T.StructType(columns))
    files = _silver_files(spark, paths, location_mode, None, _LOAD, basePath=deployment.silver)
    if gone:
        origin = F.col(ORIGIN_STREAM)
        files = files.where(origin.isNull() | ~origin.isin(gone))
    return files


def _committed_files(
    spark: SparkSession, deployment: Deployment, location_mode: str, status: str
) -> DataFrame:
    """Silver files that count; the folders of failed or replaced loads are not listed."""
    sources, gone = silver_sources(spark, deployment)
    files = silver_of_sources(spark, deployment, location_mode, sources, gone)
    return files.where(F.col(STATUS) == status)


def read_silver(
    spark: SparkSession, deployment: Deployment, location_mode: str = "string"
) -> DataFrame:
    """The 28 silver columns of all committed loads; filters on the local day prune files."""
    return _committed_files(spark, deployment, location_mode, STATUS_OK).select(*SILVER_COLUMNS)


def read_quarantine(
    spark: SparkSession, deployment: Deployment, location_mode: str = "string"
) -> DataFrame:
    """Pieces of all committed loads that could not be read, and when they came in."""
    files = _committed_files(spark, deployment, location_mode, STATUS_CORRUPT)
    return files.select(CORRUPT, *INGESTION_COLUMNS)


def read_load(
    spark: SparkSession, deployment: Deployment, load_id: str, schema: T.StructType, status: str
) -> DataFrame:
    """Rows of one load, committed or not, with ``_corrupt_record``."""
    folder = load_folder(deployment.silver, load_id)
    files = _silver_files(spark, [folder], "string", schema)
    return files.where(F.col(STATUS) == status).drop(STATUS, ORIGIN_STREAM)


def read_silver_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], **split: object
) -> DataFrame:
    """Silver from a relational table.

    Pass ``column``, ``lowerBound``, ``upperBound`` and ``numPartitions``, or ``predicates``, to
    read it in parallel; without them a single task reads the whole table.
    """
    return spark.read.jdbc(url, table, properties=properties, **split).select(*SILVER_COLUMNS)


def read_rollup(spark: SparkSession, deployment: Deployment) -> DataFrame:
    """Rollup rows of all committed loads."""
    loads = committed_loads(spark, deployment)
    return rollups_of(spark.read.parquet(f"{deployment.root}/rollup"), loads).drop("block")


def rollups_of(rollups: DataFrame, loads: DataFrame) -> DataFrame:
    """Rows of the loads; a load that failed in an earlier block left rows that are none of its."""
    typed = rollups.withColumn("block", F.col("block").cast("bigint"))
    typed = typed.withColumn(_LOAD, F.col(_LOAD).cast("string"))
    return typed.join(loads, [_LOAD, "block"], "left_semi").drop(_LOAD)


def last_refresh(spark: SparkSession, deployment: Deployment) -> Row | None:
    """The mark of the last finished gold refresh: ``refresh``, ``slot``, ``merged`` (the number up
    to which loads are in it) and ``rebuilt``."""
    finished = if_there(
        spark, lambda: spark.read.schema(_REFRESH_SCHEMA).json(deployment.refresh_marks)
    )
    if finished is None:
        return None
    newest = F.max(F.struct("refresh", "slot", "merged", "rebuilt")).alias("newest")
    return finished.where("refresh >= 0").agg(newest).first()["newest"]


def is_half_written(spark: SparkSession, deployment: Deployment, slot: int) -> bool:
    """Whether a refresh began to replace the whole slot and did not finish."""
    marks = if_there(
        spark,
        lambda: spark.read.schema(_REFRESH_SCHEMA).json(deployment.gold(slot, REFRESH_MARK)),
    )
    return marks is not None and not marks.where("refresh < 0").isEmpty()


def current_slot(spark: SparkSession, deployment: Deployment) -> int:
    newest = last_refresh(spark, deployment)
    if newest is None:
        raise ValueError(f"no finished gold refresh in {deployment.root}")
    return newest["slot"]


def stored_gold(spark: SparkSession, deployment: Deployment, slot: int, table: str) -> DataFrame:
    """``daily_wide`` or the merged rollup of a slot, also without any row.

    The type of the location name, which depends on the location mode, is that of the weather codes,
    a table that always has a file.
    """
    codes = spark.read.parquet(deployment.gold(slot, WEATHER_CODES)).schema
    is_double = isinstance(codes["location_name"].dataType, T.DoubleType)
    silver = spark.createDataFrame([], silver_schema("double" if is_double else "string"))
    empty = daily_wide(silver) if table == DAILY_WIDE else rollup(silver)
    return spark.read.schema(empty.schema).parquet(deployment.gold(slot, table))


def current_gold(spark: SparkSession, deployment: Deployment, slot: int, name: str) -> DataFrame:
    """A gold table, or ``daily_wide``, of a slot."""
    if name == "weather_condition_summary":
        return spark.read.parquet(deployment.gold(slot, WEATHER_CODES))
    wide = stored_gold(spark, deployment, slot, DAILY_WIDE)
    return wide.select(*daily_columns(name))


def read_gold(
    spark: SparkSession, deployment: Deployment, name: str, ordered: bool = False
) -> DataFrame:
    """A gold table, or ``daily_wide``, as of the last finished refresh.

    The daily tables are projections of one stored table, partitioned by day: a filter on the date
    prunes files.
    """
    if name not in GOLD_TABLES and name != DAILY_WIDE:
        raise ValueError(f"no such gold table: {name}")
    table = current_gold(spark, deployment, current_slot(spark, deployment), name)
    return order_for_reading(table, name) if ordered else table


def read_all_gold(spark: SparkSession, deployment: Deployment) -> dict[str, DataFrame]:
    """The seven gold tables, all of the same refresh."""
    slot = current_slot(spark, deployment)
    return {name: current_gold(spark, deployment, slot, name) for name in GOLD_TABLES}


#: Deployments whose views a session holds, with the location mode.
_viewed: dict[tuple[str, str], str] = {}


def register_views(
    spark: SparkSession, deployment: Deployment, location_mode: str = "string"
) -> None:
    """Temporary views ``silver_events`` and one per gold table, for SQL and reports.

    Every refresh of the deployment in this application registers them anew.
    """
    _viewed[spark.sparkContext.applicationId, deployment.root] = location_mode
    silver = read_silver(spark, deployment, location_mode)
    silver.createOrReplaceTempView("silver_events")
    for name, table in read_all_gold(spark, deployment).items():
        table.createOrReplaceTempView(name)


def renew_views(spark: SparkSession, deployment: Deployment) -> None:
    """Registers the views of the deployment again, if there are any."""
    mode = _viewed.get((spark.sparkContext.applicationId, deployment.root))
    if mode is not None:
        register_views(spark, deployment, mode)
