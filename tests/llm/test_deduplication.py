from __future__ import annotations

import random
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import brute
from skyledger.llm import jaccard, substrings, suffixes
from skyledger.llm.blocks import Sketch, blocks_of, pack, pack_sorted, unpack, unpack_sorted
from skyledger.llm.collection_index import suffix_order
from skyledger.llm.components import components

DATA = "/root/testdata/sf0.001"


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def pairs(rows):
    return [(i, t) for i, t, *_ in rows]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


# --- packed arrays and the sketch


@given(st.lists(st.integers(0, 2**32 - 1)))
def test_packed_arrays_come_back(values):
    plain = np.array(values, np.uint32)
    assert (unpack(pack(plain), np.uint32) == plain).all()
    ascending = np.sort(plain).astype(np.int64)
    assert (unpack_sorted(pack_sorted(ascending)) == ascending).all()


def test_estimates_are_never_too_low(spark, sample):
    blocks = blocks_of(sample)
    sketch = Sketch(10)  # far too narrow, so that many keys share their cells
    merged = sketch.merge(blocks, lambda block: block.word_hashes(0))

    def compare(block, number, answers):
        keys, counts = np.unique(block.word_hashes(0), return_counts=True)
        estimate = sketch.estimates(keys, answers).astype(int)
        yield {"low": [int((estimate < np.minimum(counts, 65535)).sum())], "n": [len(keys)]}

    rows = blocks.with_answers(merged, compare, "low long, n long").collect()
    assert sum(r.n for r in rows) > 1000
    assert sum(r.low for r in rows) == 0


# --- word windows


@pytest.mark.parametrize("width", [13, 4, 1])
def test_substrings_of_odd_documents(odd, odd_rows, width):
    got = substrings.remove_repeats(odd, width).collect()
    assert bag(got) == bag(brute.substring_dedup(pairs(odd_rows), width))


def test_substrings_of_sample_documents(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    got = substrings.remove_repeats(sample).collect()
    expected = brute.substring_dedup(rows, 13)
    assert sum(r[2] for r in expected) > 100
    assert bag(got) == bag(expected)


def thue_morse(n, letters):
    """A word whose polynomial hash modulo 2**64 is that of the word with its letters swapped."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [32, 64, 1024, 2048, 4096])
def test_words_made_to_share_a_hash(spark, n):
    one, two = thue_morse(n, "ab"), thue_morse(n, "ba")
    ahead, behind = "x y z u v w", "one two three four five six"
    rows = [
        (1, f"{ahead} {one} {behind}"), (2, f"{ahead} {two} {behind}"), (3, one), (4, two),
        (5, one.upper()), (6, f"{ahead} {one} {behind}"), (7, f"{ahead} {two.upper()} {behind}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert bag(substrings.remove_repeats(docs).collect()) == bag(brute.substring_dedup(rows, 13))
    got = jaccard.join(docs, 13, 100).collect()
    assert bag(got) == bag(brute.jaccard_join(rows, 13, 100))
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 3, 6: 1, 7: 2}


def test_no_documents(none):
    assert substrings.remove_repeats(none).count() == 0
    assert suffixes.remove_repeats(none).count() == 0
    assert jaccard.join(none).count() == 0


# --- suffix order


def plain_order(documents, cap):
    suffixes_ = [(d[len(d) - n :], i, n) for i, d in enumerate(documents) for n in range(len(d) + 1)]
    suffixes_.sort(key=lambda s: s[0])
    common = [0]
    for (a, *_), (b, *_) in zip(suffixes_, suffixes_[1:]):
        n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        common.append(min(n, cap))
    return [s[0] for s in suffixes_], common


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=12), min_size=1, max_size=8))
def test_suffix_order(documents):
    symbols = np.array([s for d in documents for s in d])
    lengths = np.array([len(d) for d in documents])
    owner, size, common = suffix_order(symbols, np.cumsum(lengths) - lengths, lengths, 5)
    texts, expected = plain_order(documents, 5)
    got = [documents[o][len(documents[o]) - n :] for o, n in zip(owner, size)]
    assert got == texts
    assert common.tolist() == expected


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 5))
def test_repeated_windows(seed, n):
    r = random.Random(seed)
    core = bytes(r.choices(b"ab", k=40))
    contents, offsets = [], []
    for _ in range(n):
        left, right = bytes(r.choices(b"ab", k=r.randint(0, 9))), bytes(r.choices(b"ab", k=r.randint(0, 9)))
        contents.append(left + core + right)
        offsets.append(len(left))
    weights = [r.randint(1, 2) for _ in contents]
    length = 32
    counts = {}
    for c, o, w in zip(contents, offsets, weights):
        for k in range(len(c) - length + 1):
            place = (c[k : k + length], o - k)
            counts[place] = counts.get(place, 0) + w
    masks = suffixes.repeated_windows(contents, offsets, weights, length)
    for c, o, mask in zip(contents, offsets, masks):
        expected = [counts[c[k : k + length], o - k] >= 2 for k in range(len(c) - length + 1)]
        assert mask.tolist() == expected


@pytest.mark.parametrize("hot", [suffixes.HOT, 2])
def test_suffixes_of_odd_documents(odd, odd_rows, hot):
    got = suffixes.remove_repeats(odd, hot=hot).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept"
    )
    expected = brute.suffix_dedup(pairs(odd_rows), 200)
    rows = [(*r[:4], bytes(r[4])) for r in got.collect()]
    assert bag(rows) == bag(expected)


@pytest.mark.parametrize("hot", [suffixes.HOT, 3])
def test_suffixes_of_sample_documents(sample, hot):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    got = suffixes.remove_repeats(sample, hot=hot).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept"
    )
    expected = brute.suffix_dedup(rows, 200)
    assert sum(r[2] for r in expected) > 1000
    assert bag((*r[:4], bytes(r[4])) for r in got.collect()) == bag(expected)


def test_kept_text_and_carried_columns(spark):
    passage = "ñ" * 100 + "b" * 100
    at = datetime(2024, 2, 3, 4, 5, 6, 123456)
    rows = [
        (1, "é" + passage, "x", at, {"b": 1, "a": None}, bytearray(b"\x00\xff")),
        (2, passage + "é", None, None, None, None),
    ]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, more string, at timestamp, m map<string, int>, raw binary"
    )
    got = suffixes.remove_repeats(docs, as_text=True, carry=("more", "at", "m", "raw")).collect()
    assert bag((r.doc_id, r.kept, *r.carried) for r in got) == bag(
        (i, "é", *others) for i, _, *others in rows
    )
    with pytest.raises(ValueError):
        suffixes.remove_repeats(docs, length=100)


# --- similar documents


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (2, 50)])
def test_join_of_odd_documents(odd, odd_rows, words, percent):
    got = jaccard.join(odd, words, percent).collect()
    assert bag(got) == bag(brute.jaccard_join(pairs(odd_rows), words, percent))


@pytest.mark.parametrize("tile", [jaccard.TILE, 4])
def test_join_of_families(spark, tile):
    """Copies of a few texts with more and more changes, so that links run in chains."""
    r = random.Random(3)
    rows = []
    for family in range(4):
        base = [f"w{r.randint(0, 500)}" for _ in range(80)]
        for k in range(25):
            copy = list(base)
            for _ in range(r.randint(0, 4 if family else 8)):
                copy[r.randrange(80)] = f"n{r.randint(0, 9999)}"
            rows.append((family * 100 + k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.join(docs, 4, 60, tile).collect()
    expected = brute.jaccard_join(rows, 4, 60)
    assert 8 < len({c for _, _, c in expected}) < 100
    assert bag(got) == bag(expected)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32))
def test_adaptive_join_finds_all_links(seed):
    r = random.Random(seed)
    universe = list(range(1, 60))
    base = r.sample(universe, 30)
    sets = []
    for _ in range(25):
        own = set(base) - set(r.sample(base, r.randint(0, 8))) | set(r.sample(universe, r.randint(0, 4)))
        sets.append(np.array(sorted(own, key=lambda t: (t * 7919) % 61), np.uint64))
    n = len(sets)
    links = jaccard.adaptive_join(list(range(n)), np.arange(n), np.full(n, 2), sets, 70)
    known, plain = brute.Groups(), brute.Groups()
    for a, b in links:
        assert jaccard.similar(sets[a], sets[b], 70)
        known.join(a, b)
    for a in range(n):
        for b in range(a):
            if jaccard.similar(sets[a], sets[b], 70):
                plain.join(a, b)
    assert [known.root(i) for i in range(n)] == [plain.root(i) for i in range(n)]


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 60)] + [(3, 3), (5, 4)]
    edges += [(b, a) for a, b in edges[:20]]
    r.shuffle(edges)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = brute.Groups()
    for a, b in edges:
        groups.join(a, b)
    assert bag(got) == bag((x, groups.root(x)) for x in groups.parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_group_of_copies(spark):
    """A third of all rows are copies of one text, another third near copies of another."""
    r = random.Random(2)
    one, two = ([f"w{r.randint(0, 900)}" for _ in range(60)] for _ in range(2))
    rows = [(i, " ".join(one)) for i in range(100)]
    for i in range(100, 200):
        near = list(two)
        near[r.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join(f"u{r.randint(0, 10**6)}" for _ in range(60))) for i in range(200, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = jaccard.join(docs, 4, 75)
    assert bag(got.collect()) == bag(brute.jaccard_join(rows, 4, 75))
    assert got.select(F.countDistinct("component_id")).first()[0] < 110
    stripped = substrings.remove_repeats(docs).collect()
    assert bag(stripped) == bag(brute.substring_dedup(rows, 13))
