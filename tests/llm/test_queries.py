"""Queries with SQL against it, over whole tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from skyledger.llm.queries import ORACLE_SQL_OF_QUERIES, QUERIES

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL_OF_QUERIES))
def test_query_equals_sql(spark, name):
    frame = QUERIES[name](spark, DATA)
    with duckdb.connect() as connection:
        for table in ("documents", "embeddings"):
            connection.execute(f"create view {table} as from '{DATA}/{table}.parquet'")
        result = connection.execute(ORACLE_SQL_OF_QUERIES[name])
        names = [c[0] for c in result.description]
        expected = Counter(result.fetchall())
    assert sorted(names) == sorted(frame.columns)
    assert Counter(map(tuple, frame.select(names).collect())) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL_OF_QUERIES)))
def test_query_returns_a_row_per_document(spark, name):
    frame = QUERIES[name](spark, DATA)
    key, table = ("vec_id", "embeddings") if "vec_id" in frame.columns else ("doc_id", "documents")
    ids = {r[0] for r in frame.select(key).collect()}
    assert ids == {r[0] for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(key).collect()}
