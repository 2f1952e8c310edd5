from __future__ import annotations

import functools
import math
import random
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from skyledger.functions.rounding import UNITS_PER_ONE
from skyledger.operators import gold
from skyledger.operators.measures import Mean, named
from skyledger.plans.refresh import build_gold
from skyledger.sources.schema import EVENT_COLUMNS, silver_schema

from helpers import plan_text


def silver(spark, *rows):
    base = dict.fromkeys(silver_schema().names)
    base |= {"location_name": "A", "latitude": 1.0, "longitude": 2.0}
    base |= {"datetime_brasil": date(2024, 1, 1)}
    return spark.createDataFrame([tuple((base | row).values()) for row in rows], silver_schema())


def mean_of(spark, values):
    table = gold.gold_table(silver(spark, *({"temperature": v} for v in values)), "avg_temperature_daily")
    return table.first().avg_temperature


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([2.67, 2.68], 2.68),
        ([-2.67, -2.68], -2.68),
        ([0.01, 0.0], 0.01),
        ([-0.01, 0.0], -0.01),
        ([-0.001, 0.0], 0.0),
        ([1.005], 1.01),
        ([0.1, 0.2, 0.3, None], 0.2),
        ([None, None], None),
        ([-7.0], -7.0),
        ([1e17, 1e17], 1e17),
    ],
)
def test_mean_rounds_half_away_from_zero(spark, values, expected):
    assert mean_of(spark, values) == expected


def test_zero_mean_has_no_negative_sign(spark):
    assert math.copysign(1, mean_of(spark, [-0.001, 0.0])) == 1


def test_mean_of_values_with_many_decimals(spark):
    assert mean_of(spark, [0.123456, 0.123454]) == 0.12
    assert mean_of(spark, [1.00000001, 2.00000003, 3.0]) == 2.0


def test_means_do_not_depend_on_the_order_of_rows(spark):
    """Bit-equal means of shuffled copies, in one aggregate and merged from parts."""
    values = [math.pi * k - 900 for k in range(500)] + [k / 3_000_000 for k in range(500)]
    values += [0.005 - 1e-6, 0.005 + 1e-6, 1e-12, -1e-12, 123456.654321]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(values)
        rows = silver(spark, *({"temperature": v} for v in values)).repartition(2 + seed)
        one = gold.daily_wide(rows).first().avg_temperature
        halves = [gold.rollup(rows.where(f"pmod(hash(temperature), 3) = {k}")) for k in range(3)]
        states = functools.reduce(lambda a, b: a.unionByName(b), halves)
        seen |= {one, gold.daily_wide_from_rollup(states).first().avg_temperature}
    exact = sum(Decimal(repr(v)) for v in values) / len(values)
    assert seen == {float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))}


@pytest.mark.parametrize(
    "values, expected",
    [
        ((0.004999, 0.005001), 0.01),  # exactly 0.005
        ((-0.004999, -0.005001), -0.01),
        ((2.674998, 2.675001), 2.67),
        ((1.000001, 1.009999), 1.01),  # exactly 1.005
        ((1234567.123456, 1234567.126544), 1234567.13),  # exactly .125
    ],
)
def test_means_of_values_with_six_decimals(spark, values, expected):
    assert mean_of(spark, values) == expected


def test_mean_of_nan_and_infinity(spark):
    assert math.isnan(mean_of(spark, [1.0, math.nan]))
    assert mean_of(spark, [1.0, math.inf]) == math.inf
    assert math.isnan(mean_of(spark, [-math.inf, math.inf]))


def test_the_unit_sum_does_not_overflow(spark):
    big = 9e14  # 9e18 units, close to the end of a long
    assert mean_of(spark, [big, big, big]) == big
    assert mean_of(spark, [-big, -big, -big, 0.01]) == -675_000_000_000_000.0
    assert mean_of(spark, [big, -big, 0.03]) == 0.01


def test_a_merged_mean_does_not_overflow(spark):
    big = 9e14
    rows = [{"temperature": big, "weather_code": 1}] * 3 + [{"temperature": 1.0, "weather_code": 2}]
    wide = gold.daily_wide_from_rollup(gold.rollup(silver(spark, *rows)))
    assert wide.first().avg_temperature == (3 * big + 1) / 4


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(st.integers(-(10**7), 10**7), min_size=1, max_size=9), min_size=20, max_size=60
    )
)
def test_mean_equals_decimal_arithmetic(spark, groups):
    rows = [(g, units / UNITS_PER_ONE) for g, group in enumerate(groups) for units in group]
    mean = Mean("x")
    frame = spark.createDataFrame(rows, "g int, x double")
    states = frame.select("g", *named(mean.inputs())).groupBy("g").agg(*named(mean.states()))
    actual = {r.g: r.m for r in states.select("g", mean.result().alias("m")).collect()}
    for g, group in enumerate(groups):
        exact = Decimal(sum(group)) / Decimal(len(group) * UNITS_PER_ONE)
        assert actual[g] == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_extremes_and_counts(spark):
    rows = [
        {"cloud_base": 1.005, "cloud_ceiling": 2.675, "rain_intensity": 0.0, "snow_intensity": None},
        {"cloud_base": None, "cloud_ceiling": 9.0, "rain_intensity": 0.1, "snow_intensity": -1.0},
    ]
    frame = silver(spark, *rows)
    cloud = gold.gold_table(frame, "cloud_cover_daily").first()
    assert (cloud.avg_cloud_cover, cloud.max_cloud_base, cloud.min_cloud_ceiling) == (None, 1.01, 2.68)
    events = gold.gold_table(frame, "snow_rain_condition_daily").first()
    assert (events.rain_events, events.snow_events) == (1, 0)


def test_null_keys_and_signed_zero_group_together(spark):
    rows = [
        {"location_name": None, "datetime_brasil": None, "latitude": 0.0},
        {"location_name": None, "datetime_brasil": None, "latitude": -0.0},
    ]
    codes = gold.gold_table(silver(spark, *rows), "weather_condition_summary").collect()
    assert [(r.location_name, r.weather_code, r.weather_code_count) for r in codes] == [(None, None, 2)]


def test_reading_order(spark):
    days = [None, date(2024, 1, 2), date(2024, 1, 1)]
    frame = silver(spark, *({"datetime_brasil": d, "temperature": 1.0} for d in reversed(days)))
    table = gold.gold_table(frame, "avg_temperature_daily", ordered=True)
    assert [r.date for r in table.collect()] == days
    frame = silver(spark, *({"weather_code": c} for c in (1, 2, 2, 2, 3, 3)))
    counts = gold.gold_table(frame, "weather_condition_summary", ordered=True).collect()
    assert [r.weather_code_count for r in counts] == [3, 2, 1]


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def _some_silver(spark):
    expressions = {
        "location_name": "concat('L', if(id % 3 = 0, 0, id % 7))",
        "latitude": "cast(id % 7 as double)",
        "longitude": "cast(id % 2 as double)",
        "datetime_brasil": "date_add(date'2024-01-01', cast(id % 5 as int))",
        "weather_code": "cast(id % 4 as int)",
    }
    measures = [c for c in EVENT_COLUMNS if c not in expressions and c != "datetime_utc"]
    return spark.range(4000).selectExpr(
        *(f"{e} as {c}" for c, e in expressions.items()),
        *(
            f"if(id % {11 + i} = 0, null, cast((id * {31 + i}) % 977 - 300 as double) / 100D) as {c}"
            for i, c in enumerate(measures)
        ),
    )


def test_fused_equals_separate(spark):
    frame = _some_silver(spark)
    for name, table in build_gold(frame).items():
        separate = gold.gold_table(frame, name)
        assert table.columns == separate.columns == gold.GOLD_TABLES[name].columns
        assert _rows(table) == _rows(separate), name


def test_rollups_of_several_loads_merge(spark):
    frame = _some_silver(spark)
    parts = [frame.where(F.col("temperature") > 1), frame.where(~(F.col("temperature") > 1))]
    parts.append(frame.where(F.col("temperature").isNull()))
    states = gold.rollup(parts[0])
    for part in parts[1:]:
        states = states.unionByName(gold.rollup(part))
    assert _rows(gold.daily_wide_from_rollup(states)) == _rows(gold.daily_wide(frame))
    codes = gold.gold_table(frame, "weather_condition_summary")
    assert _rows(gold.weather_codes_from_rollup(states)) == _rows(codes)


def test_one_shuffle_and_only_the_needed_columns(spark, tmp_path):
    path = str(tmp_path / "silver")
    _some_silver(spark).write.parquet(path)
    for name in gold.GOLD_TABLES:
        plan = plan_text(gold.gold_table(spark.read.parquet(path), name))
        assert plan.count("Arguments: hashpartitioning") == 1
        assert plan.count("Location: InMemoryFileIndex") == 1
        read = plan.split("ReadSchema: struct<")[1].split(">")[0].split(",")
        table = gold.GOLD_TABLES[name]
        needed = {*table.key, *(c for m in table.measures.values() for c in m.inputs())}
        assert {field.split(":")[0] for field in read} == {c for c in needed if "__" not in c}
