"""The pipeline against plain versions of its stages, and the parts that hold it together."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from skyledger.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns for the sample documents."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").cache()
    results = [docs]
    for _, stage in corpus_pipeline.STAGES:
        results.append(stage(spark, results[-1], DATA).cache())
    return results


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert all(s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_language_keeps_clean_documents(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert after == {i: r for i, r in before.items() if any(c.isalpha() for c in r.text)}


def test_near_duplicates(stages):
    before, after = rows(stages[1]), rows(stages[2])
    joined = brute.jaccard_join([(i, r.text) for i, r in before.items()], 5, 80)
    assert after == {i: before[i] for i, _, component in joined if component == i}
    assert len(after) < len(before)


def test_repeated_text(stages):
    before, after = rows(stages[2]), rows(stages[3])
    expected = {}
    for i, _, removed, _, kept in brute.suffix_dedup([(i, r.text) for i, r in before.items()], 200):
        text = kept.decode("utf-8", "ignore")
        if not removed or text.strip(" "):
            expected[i] = text
    assert {i: r.text for i, r in after.items()} == expected
    assert all(r.n_chars == len(r.text) for r in after.values())
    assert all((r.lang, r.source) == (before[i].lang, before[i].source) for i, r in after.items())


def test_secrets(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert {i: r.text for i, r in after.items()} == {
        i: brute.redacted(r.text) for i, r in before.items()
    }


def test_packing(stages):
    before = rows(stages[4])
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    pieces = defaultdict(list)
    for r in stages[5].collect():
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(before)
    for i, r in before.items():
        own = sorted(pieces[i], key=lambda p: p.start)
        ids = [x for p in own for x in np.frombuffer(bytes(p.ids), "<u4").tolist()]
        assert ids == tokenizer.encode(r.text, add_special_tokens=False).ids + [1]


def test_run_is_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == stages[-1].columns
    wanted = {(r.doc_id, r.start, r.length) for r in stages[-1].collect()}
    assert {(r.doc_id, r.start, r.length) for r in got.collect()} == wanted


def test_odd_documents_pass_all_stages(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, DATA).cache()
            assert docs.columns[:5] == none.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()


def test_one_row_of_each_group_is_left(spark, odd, odd_rows):
    left = corpus_pipeline.near_duplicate_stage(spark, odd, DATA).collect()
    texts = [t for _, t, *_ in odd_rows]
    groups = defaultdict(set)
    for k, _, component in brute.jaccard_join(list(enumerate(texts)), 5, 80):
        if texts[k] and texts[k].split():
            groups[component].add(odd_rows[k][:2])
    firsts = [min(g, key=lambda r: (r[0] is None, r[0])) for g in groups.values()]
    assert sorted((r.doc_id, r.text) for r in left if r.text and r.text.split()) == sorted(firsts)


def test_copies_with_one_id_or_none_leave_one(spark, odd_rows, none):
    def text(words):  # no two of them share a passage of 200 bytes
        return " ".join(f"{w} word{k}" for k, w in enumerate(words * 40))

    one, two, three, four = map(text, (["alpha"], ["beta"], ["gamma"], ["delta"]))
    base = odd_rows[0][1]
    pairs = [(1, one), (1, one), (None, two), (None, two), (2, three), (None, three), (3, four)]
    pairs += [(3, base), (4, base), (None, base)]  # the id of another text
    rows = [(i, t, None if k % 2 else "en", "s", len(t)) for k, (i, t) in enumerate(pairs)]
    docs = spark.createDataFrame(rows, none.schema).repartition(3)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, DATA).cache()
    got = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(got, key=repr) == sorted(
        [(1, one), (None, two), (2, three), (3, four), (3, base)], key=repr
    )


def test_one_copy_of_the_odd_documents_passes_all_stages(spark, odd, odd_rows):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA).cache()
    base = odd_rows[0][1]
    assert [r.doc_id for r in docs.collect() if r.text == base] == [1]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert 1 in {r.doc_id for r in pieces}


def test_other_columns_pass_as_they_are(spark, odd_rows, none):
    """A time with microseconds, a map and binary data, also on repeated rows."""
    base = odd_rows[0][1]
    at = datetime(2024, 2, 3, 4, 5, 6, 123456)
    rows = [
        (1, base, "en", "s", len(base), at, {"k": 1, "a": None}, bytearray(b"\x00\xff")),
        (1, base, "en", "s", len(base), at, {"k": 1, "a": None}, bytearray(b"\x00\xff")),
        (2, base[::-1], "en", None, 1, None, {}, bytearray()),
        (3, base[5:] + base[::3], "en", None, None, at, None, None),
    ]
    schema = none.schema.simpleString()[7:-1] + ",at:timestamp,tags:map<string,int>,raw:binary"
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, DATA).cache()
        assert docs.dtypes == spark.createDataFrame([], schema).dtypes
    left = {r.doc_id: tuple(r)[5:] for r in docs.collect()}
    assert left == {i: tuple(others) for i, *_, at, tags, raw in rows for others in [(at, tags, raw)]}


def test_a_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert numbers == list(range(1, 14))
    assert corpus_pipeline.QUERIES.keys() == {"pipeline"}
