"""The seven gold tables, each alone from silver or all from one shared rollup.

The rollup groups silver by location, local day and weather code and keeps mergeable states. It is
the only step that reads silver rows; the daily tables and the weather-code table are both merges
of it, so a full refresh scans silver once instead of seven times, and a new load only adds its own
rollup rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.operators.measures import (
    CountPositive,
    CountRows,
    Maximum,
    Mean,
    Measure,
    Minimum,
    named,
)
from skyledger.sources.schema import LOCAL_DAY, LOCATION_KEY

DAY_KEY = (*LOCATION_KEY, LOCAL_DAY)
CODE_KEY = (*LOCATION_KEY, "weather_code")
ROLLUP_KEY = (*LOCATION_KEY, LOCAL_DAY, "weather_code")
DAILY_WIDE = "daily_wide"


@dataclass(frozen=True)
class GoldTable:
    key: tuple[str, ...]
    measures: dict[str, Measure]
    newest_or_largest_first: str

    @property
    def columns(self) -> list[str]:
        return [*("date" if k == LOCAL_DAY else k for k in self.key), *self.measures]


def _daily(**measures: Measure) -> GoldTable:
    return GoldTable(DAY_KEY, measures, newest_or_largest_first="date")


# Names and columns of the gold tables.
GOLD_TABLES = {
    "avg_temperature_daily": _daily(
        avg_temperature=Mean("temperature"),
        avg_apparent_temperature=Mean("temperature_apparent"),
    ),
    "precipitation_daily": _daily(
        avg_precipitation_probability=Mean("precipitation_probability"),
    ),
    "humidity_wind_daily": _daily(
        avg_humidity=Mean("humidity"),
        avg_wind_speed=Mean("wind_speed"),
    ),
    "cloud_cover_daily": _daily(
        avg_cloud_cover=Mean("cloud_cover"),
        max_cloud_base=Maximum("cloud_base"),
        min_cloud_ceiling=Minimum("cloud_ceiling"),
    ),
    "weather_condition_summary": GoldTable(
        CODE_KEY,
        {"weather_code_count": CountRows()},
        newest_or_largest_first="weather_code_count",
    ),
    "max_min_temperature_daily": _daily(
        max_temperature=Maximum("temperature"),
        min_temperature=Minimum("temperature"),
    ),
    "snow_rain_condition_daily": _daily(
        rain_events=CountPositive("rain_intensity"),
        snow_events=CountPositive("snow_intensity"),
    ),
}
DAILY_TABLES = tuple(name for name, table in GOLD_TABLES.items() if table.key == DAY_KEY)
_WIDE = _daily(
    **{out: m for name in DAILY_TABLES for out, m in GOLD_TABLES[name].measures.items()}
)
_EVERY_MEASURE = (*_WIDE.measures.values(), CountRows())


def _parts(measures, part: str) -> dict[str, Column]:
    return {name: c for measure in measures for name, c in getattr(measure, part)().items()}


def _aggregate_silver(silver: DataFrame, key: tuple[str, ...], measures) -> DataFrame:
    inputs = _parts(measures, "inputs")
    return (
        silver.select(*key, *named({n: c for n, c in inputs.items() if n not in key}))
        .groupBy(*key)
        .agg(*named(_parts(measures, "states")))
    )


def _results(states: DataFrame, table: GoldTable) -> DataFrame:
    key = [F.col(k).alias("date") if k == LOCAL_DAY else F.col(k) for k in table.key]
    return states.select(*key, *named({out: m.result() for out, m in table.measures.items()}))


def _merged(rollup: DataFrame, table: GoldTable) -> DataFrame:
    states = rollup.groupBy(*table.key).agg(*named(_parts(table.measures.values(), "merge")))
    return _results(states, table)


def gold_table(silver: DataFrame, name: str, ordered: bool = False) -> DataFrame:
    """One gold table straight from silver; reads only the columns that table needs."""
    table = GOLD_TABLES[name]
    states = _aggregate_silver(silver, table.key, table.measures.values())
    result = _results(states, table)
    return order_for_reading(result, name) if ordered else result


def daily_wide(silver: DataFrame) -> DataFrame:
    """All daily measures in one aggregate."""
    return _results(_aggregate_silver(silver, _WIDE.key, _WIDE.measures.values()), _WIDE)


def rollup(silver: DataFrame) -> DataFrame:
    """Mergeable states of every gold measure by location, local day and weather code."""
    return _aggregate_silver(silver, ROLLUP_KEY, _EVERY_MEASURE)


def merge_rollups(states: DataFrame, *more: str) -> DataFrame:
    """Rollup rows of several loads to one row per key, still mergeable; ``more`` columns keep rows
    apart."""
    return states.groupBy(*ROLLUP_KEY, *more).agg(*named(_parts(_EVERY_MEASURE, "merge")))


def daily_wide_from_rollup(states: DataFrame) -> DataFrame:
    return _merged(states, _WIDE)


def weather_codes_from_rollup(states: DataFrame) -> DataFrame:
    return _merged(states, GOLD_TABLES["weather_condition_summary"])


def merge_weather_codes(counts: DataFrame) -> DataFrame:
    """Weather-code counts of several parts to one row per key."""
    table = GOLD_TABLES["weather_condition_summary"]
    return counts.groupBy(*table.key).agg(*(F.sum(m).alias(m) for m in table.measures))


def daily_columns(name: str) -> list[str]:
    """Columns of a daily table, or of the wide one that holds them all."""
    return (_WIDE if name == DAILY_WIDE else GOLD_TABLES[name]).columns


def daily_tables(wide: DataFrame) -> dict[str, DataFrame]:
    """The six daily tables as plain projections of the wide one."""
    return {name: wide.select(*daily_columns(name)) for name in DAILY_TABLES}


def order_for_reading(table: DataFrame, name: str) -> DataFrame:
    """Newest day or largest count first; rows without a day come first, as in the reports.

    Rows of one day or count follow by their other key columns, so the order is total and the sort
    can split a day over several tasks.
    """
    first = GOLD_TABLES[name].newest_or_largest_first
    others = [c for c in table.columns if c in (*LOCATION_KEY, "weather_code")]
    return table.orderBy(F.desc_nulls_first(first), *(F.asc_nulls_first(c) for c in others))


def numbered(ordered: DataFrame) -> DataFrame:
    """An ordered frame with ``row_id``, which ascends with the order; to be stored."""
    return ordered.withColumn("row_id", F.monotonically_increasing_id())


def with_position(stored: DataFrame) -> DataFrame:
    """Rows of a stored ``numbered`` frame with their ``position`` from 0.

    A row id tells the partition and the row in it. The rows of the partitions before come from a
    table with one row per partition, so no task sees more than its part.
    """
    parted = stored.withColumn("part", F.shiftright("row_id", 33))
    sizes = parted.groupBy("part").agg(F.count("*").alias("n"), F.min("row_id").alias("low"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    offsets = sizes.select("part", "low", before.alias("before"))
    position = F.col("before") + F.col("row_id") - F.col("low")
    return parted.join(F.broadcast(offsets), "part").select(
        *(c for c in stored.columns if c != "row_id"), position.alias("position")
    )


def in_long_form(name: str, table: DataFrame) -> DataFrame:
    """Any gold table as one row per measure, so that all seven can be stacked."""
    spec = GOLD_TABLES[name]
    day = F.col("date") if "date" in spec.columns else F.lit(None).cast("date")
    code = F.col("weather_code") if "weather_code" in spec.columns else F.lit(None).cast("int")
    keyed = table.select(
        F.lit(name).alias("table_name"),
        *LOCATION_KEY,
        day.alias("date"),
        code.alias("weather_code"),
        *(F.col(m).cast("double").alias(m) for m in spec.measures),
    )
    ids = ["table_name", *LOCATION_KEY, "date", "weather_code"]
    return keyed.unpivot(ids, list(spec.measures), "measure", "value")
