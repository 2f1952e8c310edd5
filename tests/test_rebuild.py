"""Rebuilds of gold over many loads."""

from __future__ import annotations

import json
import shutil
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyledger.operators import gold
from skyledger.plans import refresh
from skyledger.plans.storage import MARKS_PER_BLOCK, Deployment
from skyledger.sinks.tables import land_documents
from skyledger.sources import commits
from skyledger.sources.sample_documents import events_table, weather_documents
from skyledger.sources.tables import last_refresh, read_gold

from helpers import plan_text

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def deployment(tmp_path):
    return Deployment(str(tmp_path / "deployment"))


def copy_loads(deployment, template: Path, numbers, stream=None):
    """Committed loads whose rollups are copies of one, written as plain files."""
    for number in numbers:
        block = number // MARKS_PER_BLOCK
        target = Path(deployment.rollups(block)) / f"load=copy-{number}"
        target.mkdir(parents=True)
        shutil.copy(template, target / "part-0.parquet")
        marks = Path(deployment.commits(block))
        marks.mkdir(parents=True, exist_ok=True)
        mark = {"number": number, "block": block, "load": f"copy-{number}", "stream": stream}
        (marks / f"part-{number}.json").write_text(json.dumps(mark) + "\n")


@pytest.fixture
def first_load(spark, deployment):
    """One small load and the file of its rollup."""
    documents = weather_documents(events_table(spark, DATA)).where("event_id < 40")
    land_documents(documents, deployment.raw, date(2025, 4, 10))
    refresh.append_all(spark, deployment)
    (load,) = Path(deployment.rollups(0)).glob("load=*")
    return max(load.glob("part-*.parquet"), key=lambda p: p.stat().st_size)


def counted(spark, deployment):
    codes = read_gold(spark, deployment, "weather_condition_summary")
    return codes.agg(F.sum("weather_code_count")).first()[0]


def rebuilt_plan(spark, deployment, last):
    marks = commits.marks_above(spark, deployment, -1)
    blocks = range(last // MARKS_PER_BLOCK + 1)
    merged = refresh._merged_blocks(spark, deployment)
    return plan_text(refresh._new_states(spark, deployment, marks, blocks, merged), "simple")


def test_closed_blocks_are_merged_once(spark, deployment, first_load):
    copy_loads(deployment, first_load, range(1, 250))
    refresh.refresh_gold(spark, deployment)
    assert counted(spark, deployment) == 250 * 40
    assert refresh._merged_blocks(spark, deployment) == {0, 1}
    # what became of the loads' own rollups does not matter any more
    for block in (0, 1):
        shutil.rmtree(deployment.rollups(block))
    before = {name: read_gold(spark, deployment, name).collect() for name in gold.GOLD_TABLES}
    refresh.refresh_gold(spark, deployment, from_all_loads=True)
    assert counted(spark, deployment) == 250 * 40
    for name, rows in before.items():
        again = read_gold(spark, deployment, name).collect()
        assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr), name


def test_a_stream_superseded_later_is_left_out_of_merged_blocks(spark, deployment, first_load):
    copy_loads(deployment, first_load, range(1, 60), stream="old")
    copy_loads(deployment, first_load, range(60, 130))
    refresh.refresh_gold(spark, deployment)
    assert counted(spark, deployment) == 130 * 40
    mark = {"number": 130, "block": 1, "stream": "new", "supersedes": "old"}
    (Path(deployment.commits(1)) / "part-130.json").write_text(json.dumps(mark) + "\n")
    refresh.refresh_gold(spark, deployment)
    assert last_refresh(spark, deployment)["rebuilt"]
    assert counted(spark, deployment) == (130 - 59) * 40


def test_the_plan_of_a_rebuild_does_not_grow(spark, deployment, first_load):
    copy_loads(deployment, first_load, range(1, 250))
    refresh.refresh_gold(spark, deployment)
    small = rebuilt_plan(spark, deployment, 249)
    copy_loads(deployment, first_load, range(250, 4000))
    refresh.refresh_gold(spark, deployment)
    assert refresh._merged_blocks(spark, deployment) == set(range(40))
    large = rebuilt_plan(spark, deployment, 3999)
    assert large.count("Scan parquet") <= small.count("Scan parquet") <= 2
    assert large.count("\n") <= small.count("\n")
    refresh.refresh_gold(spark, deployment, from_all_loads=True)
    assert counted(spark, deployment) == 4000 * 40
