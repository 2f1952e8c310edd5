"""Nested weather documents to the flat silver table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyledger.functions.casts import as_double, as_int, local_day
from skyledger.sources.schema import LOCAL_DAY, MEASUREMENTS, WHOLE_NUMBERS, snake_case


def flatten(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The fields of nested documents as flat columns with silver names, values as they came."""
    return documents.select(
        F.col("location.name").alias("location_name"),
        F.col("location.lat").alias("latitude"),
        F.col("location.lon").alias("longitude"),
        F.col("data.time").alias("datetime_utc"),
        *(F.col(f"data.values.{m}").alias(snake_case(m)) for m in MEASUREMENTS),
        *keep,
    )


def typed_silver(
    fields: DataFrame,
    location_mode: str = "string",
    ingested_at: datetime | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Flat fields to one silver row each: 28 typed columns, then the ``keep`` columns.

    ``location_mode="double"`` casts the location name to double, which gives NULL for any name
    that is not a number. ``ingested_at`` replaces the current time in both ingestion columns.
    """
    if location_mode not in ("string", "double"):
        raise ValueError(f"location_mode must be 'string' or 'double', not {location_mode!r}")
    name = F.col("location_name")
    time = F.col("datetime_utc").cast("string")
    texts = {f.name for f in fields.schema if isinstance(f.dataType, T.StringType)}

    def number(column: str, cast=as_double) -> Column:
        return cast(F.col(column), is_text=column in texts).alias(column)

    now = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return fields.select(
        (name.try_cast("double") if location_mode == "double" else name.cast("string")).alias(
            "location_name"
        ),
        number("latitude"),
        number("longitude"),
        time.alias("datetime_utc"),
        local_day(time).alias(LOCAL_DAY),
        *(
            number(snake_case(m), as_int if m in WHOLE_NUMBERS else as_double)
            for m in MEASUREMENTS
        ),
        now.cast("date").alias("ingestion_at"),
        now.alias("ingestion_at_timestamp"),
        *keep,
    )


def to_silver(
    documents: DataFrame,
    location_mode: str = "string",
    ingested_at: datetime | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Nested documents to silver; see ``typed_silver``."""
    return typed_silver(flatten(documents, keep), location_mode, ingested_at, keep)
