"""What the physical plans must look like."""

from __future__ import annotations

import re

import pytest

from skyledger.operators import alerts, gold
from skyledger.operators.silver import flatten, to_silver
from skyledger.plans.queries import QUERIES
from skyledger.sources.envelope import decode_envelopes, decoded, read_envelopes, to_envelopes
from skyledger.sources.raw import read_raw, to_lines, well_formed
from skyledger.sources.sample_documents import events_table, weather_documents

from helpers import plan_text

DATA = "/root/testdata/sf0.001"
# The JVM leaves larger methods to its interpreter.
COMPILED_UP_TO = 8000

ONE_SHUFFLE = [
    *gold.GOLD_TABLES,
    "gold_fused_daily",
    "silver_location_double",
]
NO_SHUFFLE = ["silver_local_day", "alert_inputs", "location_label", "alert_rules", "alert_digests"]


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def largest_method(frame) -> int:
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", plan_text(frame, "codegen"))
    assert sizes
    return max(map(int, sizes))


def exchanges(frame) -> int:
    return len(re.findall(r"\n\(\d+\) Exchange", plan_text(frame)))


@pytest.mark.parametrize("name", [*ONE_SHUFFLE, *NO_SHUFFLE, "gold_from_rollup", "alert_summary"])
def test_generated_methods_get_compiled(spark, static_plans, name):
    assert largest_method(QUERIES[name](spark, DATA)) < COMPILED_UP_TO


def test_generated_methods_of_the_way_from_files(spark, static_plans, tmp_path):
    documents = weather_documents(events_table(spark, DATA))
    raw, inbox = str(tmp_path / "raw"), str(tmp_path / "in")
    to_lines(documents).write.text(f"{raw}/2025/04/10")
    to_envelopes(documents).write.text(inbox)
    for frame in (
        to_silver(well_formed(read_raw(spark, raw))),
        to_silver(well_formed(read_raw(spark, raw)), location_mode="double"),
        alerts.alert_digests(
            alerts.alert_inputs(flatten(decoded(decode_envelopes(read_envelopes(spark, inbox)))))
        ),
    ):
        assert largest_method(frame) < COMPILED_UP_TO
        assert exchanges(frame) == 0


def test_shuffles(spark, static_plans):
    assert {name: exchanges(QUERIES[name](spark, DATA)) for name in ONE_SHUFFLE + NO_SHUFFLE} == {
        **dict.fromkeys(ONE_SHUFFLE, 1),
        **dict.fromkeys(NO_SHUFFLE, 0),
    }
