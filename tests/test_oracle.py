"""Every query against its SQL in the checking engine, over whole tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry
from oracle_queries import ORACLE_SQL
from skyledger.plans.queries import QUERIES

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    connection.execute(f"create view events as from '{DATA}/events.parquet'")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    frame = QUERIES[name](spark, DATA)
    result = oracle.execute(ORACLE_SQL[name])
    names = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(names)
    expected = _bag(names, result.fetchall())
    actual = _bag(frame.columns, frame.collect())
    assert sum(expected.values()) > 0
    assert actual - expected == Counter()
    assert expected - actual == Counter()


def test_entry(spark):
    assert entry(spark).count() > 0
