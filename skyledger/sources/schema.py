"""Schemas of the weather document, the stream envelope and the silver table."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Measurement names of the weather document, in silver column order.
MEASUREMENTS = (
    "cloudBase",
    "cloudCeiling",
    "cloudCover",
    "dewPoint",
    "freezingRainIntensity",
    "humidity",
    "precipitationProbability",
    "pressureSeaLevel",
    "pressureSurfaceLevel",
    "rainIntensity",
    "sleetIntensity",
    "snowIntensity",
    "temperature",
    "temperatureApparent",
    "uvHealthConcern",
    "uvIndex",
    "visibility",
    "weatherCode",
    "windDirection",
    "windGust",
    "windSpeed",
)
# The two measurements that silver stores as whole numbers.
WHOLE_NUMBERS = ("uvHealthConcern", "weatherCode")

CORRUPT = "_corrupt_record"
TEXT_LINE = "value"


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z])([A-Z])", r"_\1", name).lower()


# Numbers are read as text: an alert shows 25 as 25 and 25.5 as 25.5, and silver casts leniently, so
# that a bad value costs that value and not its record.
_TEXT = T.StringType()
_VALUES = T.StructType([T.StructField(m, _TEXT) for m in MEASUREMENTS])
DOCUMENT_SCHEMA = (
    T.StructType()
    .add("data", T.StructType().add("time", _TEXT).add("values", _VALUES))
    .add("location", T.StructType().add("lat", _TEXT).add("lon", _TEXT).add("name", _TEXT))
)

# The keys of the envelope. The list is opened in a second step, so that one of another
# type can be told from none.
ENVELOPE_SCHEMA = T.StructType().add("Records", T.StringType())
RECORDS_SCHEMA = T.ArrayType(
    T.StructType().add("kinesis", T.StructType().add("data", T.StringType()))
)

# Partition column of the silver files: lines that could not be read lie beside the others.
STATUS = "status"
STATUS_OK = "ok"
STATUS_CORRUPT = "corrupt"

# In compacted silver files: the ingest stream that a row came by, if it came by one.
ORIGIN_STREAM = "origin_stream"

LOCATION_KEY = ("location_name", "latitude", "longitude")
LOCAL_DAY = "datetime_brasil"
INGESTION_COLUMNS = ("ingestion_at", "ingestion_at_timestamp")


def silver_schema(location_mode: str = "string") -> T.StructType:
    """The 28 silver columns in order; ``location_mode`` sets the type of the name."""
    schema = (
        T.StructType()
        .add("location_name", T.DoubleType() if location_mode == "double" else T.StringType())
        .add("latitude", T.DoubleType())
        .add("longitude", T.DoubleType())
        .add("datetime_utc", T.StringType())
        .add(LOCAL_DAY, T.DateType())
    )
    for m in MEASUREMENTS:
        schema.add(snake_case(m), T.IntegerType() if m in WHOLE_NUMBERS else T.DoubleType())
    return schema.add("ingestion_at", T.DateType()).add(
        "ingestion_at_timestamp", T.TimestampType()
    )


SILVER_COLUMNS = tuple(silver_schema().names)
EVENT_COLUMNS = tuple(c for c in SILVER_COLUMNS if c not in INGESTION_COLUMNS)
