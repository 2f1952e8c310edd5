"""Silver loads rewritten into fewer, larger files, clustered by day and location.

A load writes a file per day and task, so months of hourly loads leave thousands of small files per
day. A compaction takes the loads since the last one, writes their rows as one load in the order of
day and location and puts itself in their place with one mark. Earlier compactions that hold no more
loads than the new one are taken along, so a row is rewritten a logarithmic number of times and as
many compactions remain.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger.plans.storage import Deployment, folder_bytes, load_folder, remove_folder
from skyledger.sources.commits import (
    COMPACTION_SCHEMA,
    Source,
    all_compactions,
    loads_of,
    silver_sources,
)
from skyledger.sources.schema import (
    CORRUPT,
    LOCAL_DAY,
    LOCATION_KEY,
    ORIGIN_STREAM,
    SILVER_COLUMNS,
    STATUS,
)
from skyledger.sources.tables import silver_of_sources

FILE_BYTES = 256 << 20
#: Rows that a task sorts, in memory: there a row may take thirty times its bytes in a file.
TASK_BYTES = 512 << 20
LEAST_LOADS = 2
#: A column of a row that is sorted, in bytes, and the row's places in the sorter besides.
_COLUMN_BYTES = 8
_ROW_BYTES = 64


def _chosen(sources: list[Source], gone: list[str]) -> list[Source]:
    """The loads since the last compaction, and the compactions that are merged with them: all of
    them once a stream is gone, whose rows then are left out for good."""
    if gone:
        return sources
    chosen = [s for s in sources if s.loads == 1 and not s.compacted]
    rest = sorted((s for s in sources if s.compacted), key=lambda s: s.first)
    loads = len(chosen)
    while loads and rest and rest[-1].loads <= loads:
        chosen.append(rest[-1])
        loads += rest.pop().loads
    return chosen


def _with_streams(rows: DataFrame, sources: list[Source]) -> DataFrame:
    """With the stream of the plain loads in ``origin_stream`` too; compactions have it there."""
    known = [(s.load, s.stream) for s in sources if s.stream is not None]
    streams = rows.sparkSession.createDataFrame(known, "load string, own_stream string")
    joined = rows.join(streams, "load", "left")
    return joined.withColumn(ORIGIN_STREAM, F.coalesce("own_stream", ORIGIN_STREAM))


def _sorted_bytes(rows: DataFrame) -> int:
    """What the rows take in memory when they are sorted: 8 bytes a column and the texts themselves."""
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType)]
    # padded to whole words, as rows hold them
    lengths = [F.coalesce(F.octet_length(c) + F.lit(7), F.lit(0)).cast("bigint") for c in texts]
    fixed = _ROW_BYTES + _COLUMN_BYTES * len(rows.columns)
    return rows.agg(F.sum(sum(lengths, F.lit(fixed).cast("bigint")))).first()[0] or 0


def _arranged(rows: DataFrame, files: int) -> DataFrame:
    """In the order of day and location, in ``files`` parts of about one size.

    Small days share a part; a large one is cut between locations, and a large location between
    times and rows, so that no key makes a part larger than the others.
    """
    order = [STATUS, LOCAL_DAY, *LOCATION_KEY, "datetime_utc"]
    numbered = rows.withColumn("row_number", F.monotonically_increasing_id())
    parts = numbered.repartitionByRange(files, *order, "row_number")
    return parts.sortWithinPartitions(*order).drop("row_number")


def compact(
    spark: SparkSession,
    deployment: Deployment,
    location_mode: str = "string",
    file_bytes: int = FILE_BYTES,
    least_loads: int = LEAST_LOADS,
    task_bytes: int = TASK_BYTES,
) -> str | None:
    """Rewrite the committed loads since the last compaction; the name of the load that stands for
    them now, or None where there are fewer than ``least_loads``.

    Rows, those in quarantine too, stay the same. The mark is written last: until then every reader
    sees the loads as they were, and a compaction that dies leaves files that nobody reads. A reader
    that opened silver before keeps the files it listed, since they are left where they are until
    ``remove_replaced``. Gold is not touched. There must be one compaction at a time, and none beside a load.

    A task writes about ``file_bytes`` of files or sorts about ``task_bytes`` of rows in memory, whichever
    is less: equal values take next to nothing in a file, and in memory as much as any.
    """
    sources, gone = silver_sources(spark, deployment)
    chosen = _chosen(sources, gone)
    if sum(s.loads for s in chosen) < least_loads:
        return None
    size = sum(folder_bytes(spark, load_folder(deployment.silver, s.load)) for s in chosen)
    rows = silver_of_sources(spark, deployment, location_mode, chosen, gone)
    columns = [*SILVER_COLUMNS, CORRUPT, STATUS, ORIGIN_STREAM]
    first, last = min(s.first for s in chosen), max(s.last for s in chosen)
    load = f"compact-{first}-{last}-{uuid.uuid4().hex}"
    in_memory = _sorted_bytes(rows.select(*columns))
    parts = max(1, -(-size // file_bytes), -(-in_memory // task_bytes))
    arranged = _arranged(_with_streams(rows, chosen).select(*columns), parts)
    arranged.write.mode("overwrite").partitionBy(STATUS, LOCAL_DAY).parquet(
        load_folder(deployment.silver, load)
    )
    number = max((c.number for c in all_compactions(spark, deployment)), default=-1) + 1
    mark = [(number, load, first, last, sum(s.loads for s in chosen))]
    spark.createDataFrame(mark, COMPACTION_SCHEMA).coalesce(1).write.mode("append").json(
        deployment.compactions
    )
    return load


def remove_replaced(spark: SparkSession, deployment: Deployment) -> int:
    """Delete the files of loads that the last but one compaction, or an earlier one, replaced; how many
    loads were there.

    Readers have from one compaction to the next but one to finish with files they opened.
    """
    compactions = sorted(all_compactions(spark, deployment), key=lambda c: c.number)
    replaced: set[str] = set()
    for later in compactions[:-1]:
        replaced |= {c.load for c in compactions if c.number < later.number and later.covers(c)}
        replaced |= {s.load for s in loads_of(spark, deployment, later)}
    folders = (load_folder(deployment.silver, load) for load in sorted(replaced))
    return sum(remove_folder(spark, folder) for folder in folders)
