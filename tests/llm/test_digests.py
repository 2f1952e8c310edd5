"""The digest columns of the queries against plain versions, over whole tables."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import brute
from skyledger.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
KINDS = ("assign", "access", "hex")


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text or "") for r in rows)


def result(spark, name):
    return QUERIES[name](spark, DATA).collect()


def sha256(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize(
    "name, file, capacity",
    [("op3_harmonic_packing", "byte_bpe_50k.json", 2048), ("op12_best_two_fit", "word_bpe_49k.json", 4096)],
)
def test_packing(spark, documents, name, file, capacity):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in documents}
    covered, sequences = defaultdict(list), defaultdict(list)
    for r in result(spark, name):
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(packed(own)) == r.ids_crc32
        if name.startswith("op3"):
            assert r.doc_tokens == len(ids[r.doc_id])
        else:
            assert r.start == capacity * r.piece
        covered[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts, total in [(covered[i], len(x)) for i, x in ids.items()]:
        end = 0
        for start, length in sorted(parts):
            assert start == end
            end += length
        assert end == total
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= capacity


def test_bpe(spark, documents):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    expected = []
    for i, text in documents:
        ids = library.encode_ordinary(text)
        expected.append((i, len(ids), sha256(packed(ids)), sha256(text)))
    found = sorted(map(tuple, result(spark, "op4_bpe_replay")))
    assert found == expected


def test_licenses(spark, documents):
    found = {r.doc_id: r for r in result(spark, "op6_license_diagonals")}
    for i, text in documents:
        n_words, places = brute.license_places(text)
        r, starts = found[i], [p for p, _ in places]
        base = ",".join(sorted({label for _, label in places}))
        assert (r.n_words, r.n_base, r.base_labels) == (n_words, len(places), base)
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert {x for x in base.split(",") if x} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_suffixes(spark, documents):
    expected = [
        (i, n, removed, spans, sha256(kept))
        for i, n, removed, spans, kept in brute.suffix_dedup(documents, 200)
    ]
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    rows = result(spark, "op8_suffix_dedup")
    assert sorted(tuple(r[c] for c in columns) for r in rows) == expected


def test_edits(spark, documents):
    found = {r.doc_id: r for r in result(spark, "op9_merkle_fingerprint")}
    prints = {i: r.fingerprint for i, r in found.items()}
    for k, (i, text) in enumerate(documents):
        following = documents[(k + 1) % len(documents)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha256(edited))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (text == edited)
    for i, text in documents:
        for j, other in documents:
            assert (prints[i] == prints[j]) == (text == other)


def test_secrets(spark, documents):
    found = {r.doc_id: r for r in result(spark, "op10_linked_secrets")}
    for i, text in documents:
        spans, r = brute.base_spans(text), found[i]
        told = [f"{KINDS[kind]}:{start}:{stop}" for start, kind, stop in spans]
        assert r.base_sha256 == sha256(",".join(told))
        counts = [sum(kind == k for _, kind, _ in spans) for k in range(3)]
        assert [r.n_assign, r.n_access, r.n_hex] == counts
        assert set(told) <= set(r.spans.split(","))
