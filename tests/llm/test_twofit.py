"""Best-two-fit packing: the tokenizer's ids, gapless sequences, few of them."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm import twofit

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = [
    "", " ", "Don't we'll THEY'RE 'S ''s !'s x'", "a b c\x1cd\x85e\x0bf\x0cg", "İSTANBUL ΣΑΣ σς",
    "é ́x Å", "😀😀 日本語テキスト", "12 345 ½ ²", "a<|endoftext|>b <|startoftext|>", "ﬁ ǅ ß ẞ",
    "x​y ﻿ z", "\U00019036澽 ͸a", "word" * 3000, "..!?-- -a- 'tis 'Tis", "ẛ̣ Å",
]


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_words_have_the_ids_of_the_library():
    r = random.Random(3)
    alphabet = "aB'.9 \n\t é́ΣσİKK日\U00019036 \x1c<|>"
    texts = ODD_TEXTS + ["J\u030c I\u0307 H\u0331 W\u030a", "<|ENDOFTEXT|> x", "he said.\x1c so, Don't!' x'. é, É!!"]
    texts += ["".join(r.choices(alphabet, k=r.randint(1, 30))) for _ in range(3000)]
    words = twofit.Words(PATH)
    tokenizer = Tokenizer.from_file(PATH)
    for text, raw in zip(texts, words.ids([t.encode() for t in texts]), strict=True):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == expected, repr(text)


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(twofit, "_KNOWN_WORDS", 3)
    words = twofit.Words(PATH)
    for text in ["a b c d e", "a b", "f g a", "a b c d"]:
        (raw,) = words.ids([text.encode()])
        assert np.frombuffer(raw, "<u4").tolist() == ids_of(text)


def best_pair(lengths, gap):
    pairs = [a + b for i, a in enumerate(lengths) for b in lengths[:i] if a + b <= gap]
    return max(pairs, default=0)


def plain_sequence(lengths, capacity):
    """Lengths of the next sequence, by the rule, from a list that loses them."""
    members, gap = [], capacity
    while fitting := [x for x in lengths if x <= gap]:
        members.append(max(fitting))
        lengths.remove(members[-1])
        gap -= members[-1]
    if gap and len(members) > 1 and best_pair(lengths, gap + members[-1]) > members[-1]:
        total = best_pair(lengths, gap + members[-1])
        members[-1:] = [total]  # the two pieces may be split differently
    return sum(members)


def test_sequences_follow_the_rule():
    r = random.Random(8)
    for _ in range(300):
        pool, lengths = twofit.Pool(50), [r.randint(1, 49) for _ in range(r.randint(1, 25))]
        for x in lengths:
            pool.add(x, None)
        rest = list(lengths)
        members, gap = pool.sequence()
        assert sum(x for x, _ in members) == 50 - gap == plain_sequence(rest, 50)
        assert pool.tokens + 50 - gap == sum(lengths)
        assert (pool.count >= 0).all()


def test_no_piece_is_lost_between_pools():
    r = random.Random(9)
    packer = twofit.Packer(64, pool_tokens=500)
    placed, given = [], []
    for number in range(2000):
        length = r.choice([1, 5, 33, 40, 47, 64])
        placed.append((length, number))
        given += packer.place(length, number)
    given += packer.finish()
    assert sorted(x for members in given for x in members) == sorted(placed)
    assert all(0 < sum(length for length, _ in members) <= 64 for members in given)


def check(rows, documents, capacity):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(ids) and r.start == r.piece * capacity
        pieces[r.doc_id].append((r.start, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = defaultdict(list)
    for doc_id, text in documents:
        ids = [*ids_of(text or ""), 1]
        expected[doc_id] += [(k, ids[k : k + capacity]) for k in range(0, len(ids), capacity)]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_odd_documents(odd, odd_rows, capacity):
    rows = twofit.pack(odd, PATH, capacity).collect()
    check(rows, [(i, t) for i, t, *_ in odd_rows], capacity)


def test_few_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = twofit.pack(docs, PATH).collect()
    n = check(rows, [(r.doc_id, r.text) for r in docs.collect()], 4096)
    least = -(-sum(r.length for r in rows) // 4096)
    assert n <= 1.02 * least + 1


def test_empty_table(none):
    assert twofit.pack(none, PATH).collect() == []
