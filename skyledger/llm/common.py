"""What the operators share: input columns, sizes, scratch tables and Arrow helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from skyledger.plans.storage import scratch_folder

#: Bytes of text that one task is meant to get.
TASK_BYTES = 32 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_columns() -> list[Column]:
    """``doc_id`` long and ``text`` string (null: empty)."""
    return [
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ]


def texts_of(docs: DataFrame) -> DataFrame:
    """The text columns; others are left behind."""
    return docs.select(*text_columns())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def total_bytes(texts: DataFrame) -> int:
    """Bytes of all texts, by one scan."""
    return texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def write_scratch(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared scratch folder, read again: it cuts the lineage and is
    computed once, and its files outlive any executor."""
    spark = frame.sparkSession
    path = f"{scratch_folder(spark, label)}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def write_counted(
    frame: DataFrame, label: str, condition: Column | None = None
) -> tuple[DataFrame, int]:
    """As ``write_scratch``, and how many of the rows meet the condition, without a further job.

    A task that is repeated may count its rows again, so the number is good for telling some from
    none and for sizes.
    """
    counted = F.count(F.lit(1)) if condition is None else F.count_if(condition)
    seen = Observation()
    table = write_scratch(frame.observe(seen, counted.alias("n")), label)
    return table, seen.get["n"]


def binary_column(table: pa.Table | pa.RecordBatch, name: str) -> list[bytes]:
    """A string or binary column as bytes, null as empty."""
    column = table.column(name)
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def map_batches(
    frame: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """``function`` on each Arrow batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows and (result := function(batch)) is not None:
                yield result

    return frame.mapInArrow(run, schema)


def text_groups(batch: pa.RecordBatch, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices with about ``most_bytes`` of ``text`` each, at least one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that all bits of a hash depend on all of its input."""
    v = values ^ (values >> np.uint64(30))
    v = v * np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v
