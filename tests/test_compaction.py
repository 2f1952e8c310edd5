"""Compaction of silver loads: same rows, either side only, few files."""

from __future__ import annotations

from datetime import date
from unittest.mock import patch

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrame, functions as F

from skyledger.operators import gold
from skyledger.plans import compaction, refresh
from skyledger.plans.compaction import compact, remove_replaced
from skyledger.plans.storage import Deployment
from skyledger.sinks import tables as sinks
from skyledger.sources.commits import all_compactions, silver_sources
from skyledger.sources.sample_documents import events_table, weather_documents
from skyledger.sources.tables import read_gold, read_quarantine, read_silver

from helpers import document, documents_frame, plan_text, write_lines

DATA = "/root/testdata/sf0.001"
DAY = date(2025, 4, 10)
A_DAY = "datetime_brasil = date'2024-01-05'"


@pytest.fixture
def deployment(tmp_path):
    return Deployment(str(tmp_path / "deployment"))


@pytest.fixture
def documents(spark):
    return weather_documents(events_table(spark, DATA))


def load(spark, deployment, documents, number):
    raw = f"{deployment.root}/landing-{number}"
    sinks.land_documents(documents, raw, DAY)
    refresh.append_all(spark, deployment, raw)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def opened(frame) -> set[str]:
    """Files whose rows a frame reads."""
    return {r[0] for r in frame.select(F.input_file_name()).distinct().collect()}


def test_rows_stay_and_the_files_of_a_day_do_not_grow(spark, deployment, documents):
    files = []
    for number in range(6):
        load(spark, deployment, documents.where(f"event_id % 6 = {number}"), number)
        before = rows(read_silver(spark, deployment))
        assert compact(spark, deployment, least_loads=1) is not None
        assert rows(read_silver(spark, deployment)) == before
        files.append(len(opened(read_silver(spark, deployment).where(A_DAY))))
    assert len(before) == documents.count()
    # compactions of 4 and 2 loads are left, with a file of the day each
    sources, _ = silver_sources(spark, deployment)
    assert [(s.first, s.last, s.loads) for s in sources] == [(0, 3, 4), (4, 5, 2)]
    assert max(files) <= 2
    refresh.refresh_gold(spark, deployment)
    silver = read_silver(spark, deployment)
    for name in gold.GOLD_TABLES:
        assert rows(read_gold(spark, deployment, name)) == rows(gold.gold_table(silver, name)), name
    assert refresh.refresh_gold(spark, deployment) == 0  # a compaction is no new load


def test_a_reader_sees_either_side_only(spark, deployment, documents):
    for number in range(2):
        load(spark, deployment, documents.where(f"event_id % 2 = {number}"), number)
    before = read_silver(spark, deployment)
    expected, old_files = rows(before), opened(before)
    with patch.object(compaction, "COMPACTION_SCHEMA", side_effect=RuntimeError("lost")):
        with pytest.raises(Exception):
            compact(spark, deployment)  # dies after its files, before its mark
    assert opened(read_silver(spark, deployment)) == old_files
    assert rows(read_silver(spark, deployment)) == expected
    name = compact(spark, deployment)
    after = read_silver(spark, deployment)
    assert all(f"/load={name}/" in f for f in opened(after))
    assert rows(after) == rows(before) == expected  # the reader that was there before reads on
    assert compact(spark, deployment) is None  # nothing new
    assert compact(spark, deployment, least_loads=1) is None or rows(after) == expected


def test_replaced_files_are_removed_one_compaction_later(spark, deployment, documents):
    for number in range(2):
        load(spark, deployment, documents.where(f"event_id % 4 = {number}"), number)
    compact(spark, deployment)
    assert remove_replaced(spark, deployment) == 0
    reader = read_silver(spark, deployment)
    expected = rows(reader)
    for number in range(2, 4):
        load(spark, deployment, documents.where(f"event_id % 4 = {number}"), number)
    compact(spark, deployment)
    assert remove_replaced(spark, deployment) == 2  # the first two loads
    assert rows(reader) == expected  # the compaction of before is still there
    assert read_silver(spark, deployment).count() == documents.count()
    refresh.refresh_gold(spark, deployment, from_all_loads=True)
    codes = read_gold(spark, deployment, "weather_condition_summary")
    assert codes.agg(F.sum("weather_code_count")).first()[0] == documents.count()


def test_quarantine_and_rows_without_a_day_are_kept(spark, deployment, tmp_path):
    write_lines(tmp_path / "deployment/raw/2025/04/10", "f.json", "nonsense", "{}")
    docs = documents_frame(spark, document(time="never", temperature=3), document(temperature=4))
    sinks.land_documents(docs, deployment.raw, DAY)
    for _ in range(2):
        refresh.append_all(spark, deployment)
    before = rows(read_silver(spark, deployment)), rows(read_quarantine(spark, deployment))
    compact(spark, deployment)
    assert (rows(read_silver(spark, deployment)), rows(read_quarantine(spark, deployment))) == before
    assert len(before[1]) == 2


def test_streams_that_are_superseded_stay_out(spark, deployment, documents, tmp_path):
    n = documents.count()
    for part in range(2):
        sinks.land_documents(documents.where(f"event_id % 2 = {part}"), deployment.raw, date(2025, 4, 10 + part))
        refresh.run(spark, deployment)
    load(spark, deployment, documents, 0)  # of no stream
    compact(spark, deployment)
    (tmp_path / "deployment/checkpoints").rename(tmp_path / "aside")
    refresh.run(spark, deployment, supersede=True)
    assert read_silver(spark, deployment).count() == 2 * n
    compact(spark, deployment, least_loads=1)
    assert read_silver(spark, deployment).count() == 2 * n
    load(spark, deployment, documents, 1)
    compact(spark, deployment, least_loads=1)
    assert read_silver(spark, deployment).count() == 3 * n
    silver = read_silver(spark, deployment)
    refresh.refresh_gold(spark, deployment)
    for name in gold.GOLD_TABLES:
        assert rows(read_gold(spark, deployment, name)) == rows(gold.gold_table(silver, name)), name


def test_nothing_to_compact(spark, deployment):
    assert compact(spark, deployment) is None
    assert all_compactions(spark, deployment) == []


def hot_day(spark, deployment, n=40_000) -> DataFrame:
    """A day of many rows, a third of them of one place."""
    place = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 200)
    values = F.struct(F.col("id").cast("string").alias("temperature"))
    return spark.range(n).select(
        F.struct(F.lit("2025-04-10T12:00:00Z").alias("time"), values.alias("values")).alias("data"),
        F.struct(
            F.lit("1").alias("lat"), F.lit("2").alias("lon"),
            F.format_string("Place%03d, m, s, b", place).alias("name"),
        ).alias("location"),
    )


def test_a_large_day_is_cut_by_place(spark, deployment, tmp_path):
    from skyledger.operators.silver import to_silver
    from skyledger.sources.raw import parse_documents

    lines = hot_day(spark, deployment).select(F.to_json(F.struct("data", "location")).alias("value"))
    silver = to_silver(parse_documents(lines), keep=["_corrupt_record"])
    for number in range(2):
        sinks.write_load(silver, deployment, f"l{number}", count=False)
    name = compact(spark, deployment, file_bytes=20_000)
    folder = tmp_path / f"deployment/silver/load={name}/status=ok/datetime_brasil=2025-04-10"
    sizes, ranges = [], []
    for file in sorted(folder.glob("part-*.parquet")):
        data = pq.ParquetFile(file)
        sizes.append(data.metadata.num_rows)
        names = data.read(["location_name"]).column(0).to_pylist()
        ranges.append((min(names), max(names)))
    assert len(sizes) >= 8 and sum(sizes) == 80_000
    assert max(sizes) <= 3 * sum(sizes) / len(sizes)  # the hot place is cut as well
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))  # ranges of places follow each other
    wanted = read_silver(spark, deployment).where("location_name = 'Place150, m, s, b'")
    assert len(opened(wanted)) <= 2
    scan = next(s for s in plan_text(wanted).split("Scan parquet") if "PushedFilters" in s)
    assert "EqualTo(location_name,Place150" in scan.split("PushedFilters: ")[1].split("\n")[0]
    fits = [a <= "Place150, m, s, b" <= b for a, b in ranges]
    assert sum(fits) <= 2  # the statistics of the others rule them out


def test_rows_that_files_hold_in_few_bytes_are_sorted_in_many_parts(spark, deployment):
    """Equal rows: a few kB of files, and in memory some 400 bytes each."""
    same = weather_documents(events_table(spark, DATA).limit(1)).drop("event_id")
    documents = same.crossJoin(spark.range(20_000)).drop("id")
    for number in range(2):
        load(spark, deployment, documents, number)
    counted = {}

    def spy(rows, files):
        counted["parts"] = arranged(rows, files)
        return counted["parts"]

    arranged = compaction._arranged
    with patch.object(compaction, "_arranged", spy):
        assert compact(spark, deployment, task_bytes=1 << 20) is not None
    sizes = [
        r["count"] for r in counted["parts"].groupBy(F.spark_partition_id()).count().collect()
    ]
    assert sum(sizes) == 40_000
    # twice the share, since the cuts come from a sample
    assert max(sizes) * 350 <= 2 << 20
    silver = read_silver(spark, deployment)
    assert silver.count() == 40_000 and silver.distinct().count() <= 2
