"""Gold under stable names for other sessions."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from skyledger.operators import gold
from skyledger.plans import refresh
from skyledger.plans.storage import Deployment
from skyledger.sinks.catalog import publish_catalog, withdraw_catalog
from skyledger.sinks.tables import land_documents
from skyledger.sources.sample_documents import events_table, weather_documents
from skyledger.sources.tables import read_gold, read_silver

from helpers import write_lines

DATA = "/root/testdata/sf0.001"
DAY = date(2025, 4, 10)


@pytest.fixture
def deployment(tmp_path):
    return Deployment(str(tmp_path / "deployment"))


@pytest.fixture
def database(spark, tmp_path):
    name = "weather_reports"
    spark.sql(f"create database `{name}` location '{tmp_path}/{name}'")
    yield name
    spark.sql(f"drop database `{name}` cascade")


@pytest.fixture
def documents(spark):
    return weather_documents(events_table(spark, DATA))


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_a_second_session_sees_every_refresh(spark, deployment, database, documents):
    land_documents(documents.where("event_id % 4 = 0"), deployment.raw, DAY)
    refresh.run(spark, deployment)
    publish_catalog(spark, deployment, database)
    other = spark.newSession()
    other.sql(f"use `{database}`")
    for part in range(1, 4):
        before = other.sql("select sum(weather_code_count) from weather_condition_summary").first()[0]
        open_reader = other.table("daily_wide")  # looked up before the refresh, read after it
        expected = rows(open_reader)
        land_documents(documents.where(f"event_id % 4 = {part}"), deployment.raw, DAY)
        refresh.run(spark, deployment)
        assert rows(open_reader) == expected
        assert other.sql("select sum(weather_code_count) from weather_condition_summary").first()[0] > before
        for name in gold.GOLD_TABLES:
            seen = other.table(name)
            assert seen.dtypes == read_gold(spark, deployment, name).dtypes
            assert rows(seen) == rows(gold.gold_table(read_silver(spark, deployment), name)), name


def test_a_day_filter_reaches_the_files(spark, deployment, database, documents):
    land_documents(documents, deployment.raw, DAY)
    refresh.run(spark, deployment)
    publish_catalog(spark, deployment, database)
    some = spark.table(f"`{database}`.avg_temperature_daily").where("date = date'2024-01-05'")
    files = {r[0] for r in some.select(F.input_file_name()).distinct().collect()}
    assert len(files) == 1 and all("date=2024-01-05" in f for f in files)


def test_empty_tables_and_withdrawn_views(spark, deployment, database, documents, tmp_path):
    write_lines(tmp_path / "deployment/raw/2025/04/10", "f.json", "nonsense")
    refresh.run(spark, deployment)
    publish_catalog(spark, deployment, database)
    publish_catalog(spark, deployment, database)  # again is no harm
    for name in gold.GOLD_TABLES:
        seen = spark.table(f"`{database}`.{name}")
        assert seen.count() == 0 and seen.dtypes == read_gold(spark, deployment, name).dtypes
    land_documents(documents, deployment.raw, DAY)
    refresh.run(spark, deployment)
    assert spark.table(f"`{database}`.avg_temperature_daily").count() > 0
    withdraw_catalog(spark, deployment, database)
    refresh.append_all(spark, deployment)
    refresh.refresh_gold(spark, deployment)
    with pytest.raises(AnalysisException):
        spark.table(f"`{database}`.avg_temperature_daily")
