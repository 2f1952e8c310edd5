"""Weather documents derived from the ``events`` table, for queries, tests and the bench.

The expressions are plain SQL that reads the same in Spark and in the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.sources.schema import MEASUREMENTS, snake_case


def _hundredths(expression: str) -> str:
    return f"cast({expression} as double) / cast(100 as double)"


def _unless_multiple(n: int, expression: str) -> str:
    return f"case when event_id % {n} <> 0 then {expression} end"


NAME = (
    "case when user_id % 25 = 24 then 'City24, Brasil' else concat("
    "'City', cast(user_id % 25 as string), ', Micro', cast(user_id % 25 as string),"
    " ', State', cast(user_id % 5 as string), ', Region', cast(user_id % 3 as string),"
    " ', Brasil') end"
)
LATITUDE = _hundredths("-700 - (user_id % 25)")
LONGITUDE = _hundredths("-3700 - (user_id % 25)")

VALUES = {
    "cloudBase": _unless_multiple(4, _hundredths("(event_id * 17) % 1200")),
    "cloudCeiling": _unless_multiple(3, _hundredths("(event_id * 41) % 1500")),
    "cloudCover": "cast((event_id * 31) % 101 as double)",
    "dewPoint": _unless_multiple(13, _hundredths("(event_id * 23) % 3000 - 500")),
    "freezingRainIntensity": (
        "case when event_id % 97 = 0 then cast(0.25 as double) else cast(0 as double) end"
    ),
    "humidity": _unless_multiple(23, "cast((event_id * 29) % 101 as double)"),
    "precipitationProbability": "cast((event_id * 13) % 101 as double)",
    "pressureSeaLevel": _unless_multiple(37, "cast(980 + event_id % 60 as double)"),
    "pressureSurfaceLevel": "cast(900 + event_id % 110 as double)",
    "rainIntensity": (
        f"case when event_type = 'error' then {_hundredths('(event_id * 3) % 2000')}"
        " else cast(0 as double) end"
    ),
    "sleetIntensity": (
        f"case when event_id % 60 = 0 then {_hundredths('event_id % 700')}"
        " else cast(0 as double) end"
    ),
    "snowIntensity": (
        f"case when event_id % 50 = 0 then {_hundredths('event_id % 900')}"
        " else cast(0 as double) end"
    ),
    "temperature": _unless_multiple(19, _hundredths("(event_id * 37) % 6000 - 1000")),
    "temperatureApparent": _unless_multiple(17, _hundredths("(event_id * 53) % 6500 - 1500")),
    "uvHealthConcern": _unless_multiple(29, "cast(event_id % 4 as int)"),
    "uvIndex": _unless_multiple(29, "cast(event_id % 12 as double)"),
    "visibility": _unless_multiple(31, _hundredths("(event_id * 19) % 1600")),
    "weatherCode": "cast(1000 + 100 * (event_id % 8) as int)",
    "windDirection": "cast((event_id * 43) % 360 as double)",
    "windGust": _hundredths("(event_id * 11) % 4000"),
    "windSpeed": _hundredths("(event_id * 7) % 2500"),
}


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def weather_fields(events: DataFrame) -> DataFrame:
    """``event_id`` plus the fields of one weather document per event, as flat columns."""
    return events.selectExpr(
        "event_id",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as datetime_utc",
        f"{NAME} as location_name",
        f"{LATITUDE} as latitude",
        f"{LONGITUDE} as longitude",
        *(f"{VALUES[m]} as {snake_case(m)}" for m in MEASUREMENTS),
    )


def weather_documents(events: DataFrame) -> DataFrame:
    """``event_id`` plus one nested weather document per event, in the shape of the raw zone."""
    values = ", ".join(f"{snake_case(m)} as {m}" for m in MEASUREMENTS)
    return weather_fields(events).selectExpr(
        "event_id",
        f"struct(datetime_utc as time, struct({values}) as values) as data",
        "struct(latitude as lat, longitude as lon, location_name as name) as location",
    )
