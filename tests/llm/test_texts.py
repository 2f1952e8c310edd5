from __future__ import annotations

import base64
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from skyledger.llm import bpe, credentials, fingerprint, language, licenses, packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
DATA = "/root/testdata/sf0.001"


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


# --- encoding


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abAB ea\n.'tsé日1 "), max_size=60))
def test_replay_equals_the_library(encoding, text):
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    (got,) = encoder.encode([text])
    assert np.frombuffer(got, "<u4").tolist() == encoding.encode_ordinary(text)


def test_every_character_is_split_as_by_the_library(encoding):
    """Each code point behind a letter, a digit and a mark: the library gives one token for both if
    it does not split them."""
    split = bpe.Encoder(RANKS, public_tokenizers.PATTERN).split
    chars = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    for k in range(0, len(chars), 50_000):
        pairs = [before + c for c in chars[k : k + 50_000] for before in "a1!"]
        tokens = {bytes([b]): b for b in range(256)} | {
            pair.encode(): 256 + i for i, pair in enumerate(pairs)
        }
        probe = tiktoken.Encoding(
            "probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokens, special_tokens={}
        )
        whole = {pair for pair in pairs if len(probe.encode_ordinary(pair)) == 1}
        assert whole == set(pairs) & set(split("\n".join(pairs)))


def test_characters_of_newer_versions(encoding):
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    texts = ["\U00019036澽 a\U00019036 1\U00019036\U00019036", "x\U0003d000", "\u0c5c\u0c5cé 2\U00011de0"]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text)


def test_replay_with_a_small_memory(encoding, odd_rows):
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN, remembered=5)
    texts = [t or "" for _, t, *_ in odd_rows] * 2
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [encoding.encode_ordinary(t) for t in texts]


def test_encode_and_decode(odd, odd_rows, encoding, none):
    encoded = bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    got = [(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in bpe.decode(encoded, RANKS).collect()]
    assert bag(got) == bag(
        (i, np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode())
        for i, t, *_ in odd_rows
    )
    assert bpe.decode(bpe.encode(none, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


# --- packing


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60), st.integers(1, 100))
def test_packer(lengths, capacity):
    lengths = [min(n, capacity) for n in lengths]
    packer = packing.Packer(capacity)
    placed = [p for k, n in enumerate(lengths) for p in packer.place(n, k)] + list(packer.finish())
    assert sorted(p for p, _, _ in placed) == list(range(len(lengths)))
    ends = defaultdict(int)
    for piece, sequence, offset in sorted(placed, key=lambda p: p[1:]):
        assert offset == ends[sequence]
        ends[sequence] += lengths[piece]
    assert all(n <= capacity for n in ends.values())


@given(st.integers(1, 20_000), st.sampled_from([2048, 1000]), st.sampled_from([64, 1, 2048]))
def test_cuts(tokens, capacity, smallest):
    lengths = packing.cuts(tokens, capacity, smallest)
    assert sum(lengths) == tokens
    assert all(0 < n <= capacity for n in lengths)


def pieces_match(rows, texts, tokenizer):
    """Every id lies in one piece, at its place; sequences have no gap; little is padded."""
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for doc_id, own in texts.items():
        expected = sorted(tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in own)
        got = sorted(pieces[doc_id], key=lambda r: r.start)
        if len(own) == 1:
            ids = [x for r in got for x in np.frombuffer(bytes(r.ids), "<u4").tolist()]
            assert ids == expected[0]
            assert [r.start for r in got] == np.cumsum([0] + [r.length for r in got[:-1]]).tolist()
            assert {r.doc_tokens for r in got} == {len(ids)}
        assert sum(r.length for r in got) == sum(map(len, expected))
    ends = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert all(n <= 2048 for n in ends.values())
    return sum(2048 - n for n in ends.values() if n & (n - 1)), sum(ends.values())


def test_pack(odd, odd_rows, none):
    tokenizer = Tokenizer.from_file(JSON)
    texts = defaultdict(list)
    for i, t, *_ in odd_rows:
        texts[i].append(t or "")
    rows = packing.pack(odd.coalesce(1), JSON).collect()
    padded, total = pieces_match(rows, texts, tokenizer)
    assert padded < 2048
    several = packing.pack(odd, JSON).collect()  # a padded sequence at most from each partition
    assert pieces_match(several, texts, tokenizer)[0] <= 3 * 2048
    assert packing.pack(none, JSON).count() == 0


def test_checksum_of_a_piece(odd):
    rows = packing.pack(odd, JSON).select("ids", F.crc32("ids").alias("crc")).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.crc for r in rows)


def test_special_strings_go_to_the_tokenizer():
    text = "a <|endoftext|> b"
    assert packing.token_ids(text, JSON) == Tokenizer.from_file(JSON).encode(
        text, add_special_tokens=False
    ).ids


# --- licenses


def test_licenses_of_odd_documents(odd, odd_rows, none):
    got = licenses.digests(licenses.scan(odd)).collect()
    expected = []
    for i, t, *_ in odd_rows:
        n, places = brute.license_places(t)
        starts = [k for k, _ in places]
        labels = ",".join(sorted({label for _, label in places}))
        bounds = (min(starts), max(starts)) if starts else (None, None)
        expected.append((i, n, len(places), *bounds, labels))
    assert bag(r[:6] for r in got) == bag(expected)
    assert licenses.scan(none).count() == 0


def test_licenses_of_sample_documents(sample):
    got = licenses.digests(licenses.scan(sample)).collect()
    texts = {r.doc_id: r.text for r in sample.collect()}
    for r in got:
        n, places = brute.license_places(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (n, len(places))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_long_templates_allow_for_edits(spark):
    whole = (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met:"
    )
    edited = whole.replace("binary forms", "binary [sic] forms")
    half = whole[:60]
    rows = [(1, "x " * 5 + whole), (2, edited), (3, half), (4, "cc by nc " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.digests(licenses.scan(docs)).collect()}
    assert (found[1].labels, found[1].score) == ("bsd", 1.0)
    assert found[2].labels == "bsd" and found[2].score < 1
    assert found[3].labels == ""
    assert (found[4].n_base, found[4].first_word, found[4].last_word) == (3, 0, 6)


# --- language


def test_held_out_accuracy(sample):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language.fit(sample.where(~held))
    got = language.identify(sample.where(held), model).join(sample, "doc_id").collect()
    assert len(got) > 20
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
    assert not any(r.rejected for r in got)
    assert all(0 <= r.score <= 1 for r in got)


def test_probabilities_sum_to_one(sample):
    model = language.fit(sample)
    symbols = np.unique(np.concatenate([language._symbols([r.text])[0] for r in sample.take(60)]))
    context = np.array([ord(c) for c in "the"], np.uint64)
    total = sum(
        np.exp(model._log_p(np.append(context, s).astype(np.uint64))[0]) for s in symbols if s != 1
    )
    assert (total < 1.0001).all()
    assert total.max() > 0.98


def test_texts_that_no_model_explains(spark, sample):
    model = language.fit(sample)
    rows = [(1, "qzx" * 60), (2, None), (3, "123 !?"), (4, sample.first().text), (None, "kj" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert [got[i].rejected for i in (1, 2, 3, 4)] == [True, True, True, False]
    assert (got[2].lang_pred, got[2].score) == ("und", 0.0)
    assert got[3].lang_pred == "und"


def random_words(r, n):
    letters = "abcdefghijklmnopqrstuvwxyz"
    return " ".join("".join(r.choices(letters, k=r.randint(2, 9))) for _ in range(n))


def test_garbage_among_the_labelled_rows_does_not_lift_the_limit(spark):
    r = random.Random(3)
    clean = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    garbage = [(10**6 + k, random_words(r, r.randint(30, 80)), "en") for k in range(25)]
    model = language.fit(clean.unionByName(spark.createDataFrame(garbage, clean.schema)))
    texts = [
        random_words(r, 60),
        "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=300)),
        base64.b64encode(r.randbytes(300)).decode(),
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni "
        "obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on "
        "annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana "
        "sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    ]
    assert model.predict(texts)[3].all()
    kept = language.identify(clean, model).where("rejected").join(clean, "doc_id").collect()
    assert not [x.text for x in kept if any(c.isalpha() for c in x.text)]


def test_a_language_without_calibration_texts_rejects(spark):
    rows = [(k, "one two three", "en") for k in range(40)]  # too short to calibrate with
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert np.isfinite(model.reject_above).all()
    texts = ["qzx" * 60, "one two three one two three one two three"]
    assert model.predict(texts)[3].tolist() == [True, False]


def test_forty_languages_and_a_small_budget(spark):
    """A model that would be too large comes from a smaller sample; nothing fails."""
    r = random.Random(4)
    rows = []
    for k in range(40):
        letters = [chr(0x4E00 + 400 * k + i) for i in range(20)]
        rows += [(len(rows) + i, "".join(r.choices(letters, k=60)), f"l{k}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = language.fit(docs)
    small = language.fit(docs, max_bytes=whole.nbytes * 3 // 4)
    assert small.nbytes <= whole.nbytes * 3 // 4
    for model in (whole, small):
        found = {r.doc_id: r.lang_pred for r in language.identify(docs, model).collect()}
        right = sum(found[i] == lang for i, _, lang in rows)
        assert set(found) == {i for i, *_ in rows} and right >= 0.95 * len(rows)
    assert len(language.fit(docs, max_bytes=1).languages) == 40  # whatever it takes


def test_language_of_odd_documents(odd, odd_rows, none, sample):
    model = language.fit(sample)
    assert language.identify(odd, model).count() == len(odd_rows)
    assert language.identify(none, model).count() == 0
    empty = language.fit(none)
    assert {r.lang_pred for r in language.identify(odd, empty).collect()} == {"und"}
    assert language.fit(odd).languages == ["en", "fr"]


# --- fingerprints


def test_fingerprints(odd, odd_rows, none):
    got = fingerprint.fingerprints(odd).collect()
    assert bag(got) == bag((i, fingerprint.fingerprint_of(t or "")) for i, t, *_ in odd_rows)
    assert fingerprint.fingerprints(none).count() == 0


@given(st.text(st.sampled_from("ab \n"), max_size=80), st.text(st.sampled_from("ab \n"), max_size=80))
def test_equal_fingerprints_mean_equal_texts(a, b):
    one, two = fingerprint.fingerprint_of(a), fingerprint.fingerprint_of(b)
    assert (one == two) == (a == b)
    assert (fingerprint.likeness(one, two) == 1) == (a == b)
    assert fingerprint.likeness(one, two) == fingerprint.likeness(two, one)


def plain_tree(text):
    """Leaves as (section, paragraph, text) and the root, by the words of the description."""
    from hashlib import blake2b

    def digest(parts):
        return blake2b(",".join(parts).encode(), digest_size=8).hexdigest()

    sections, leaves = [[]], []
    for paragraph in text.split("\n"):
        words = paragraph.split(" ")
        cuts = [0, 4, 8, 12] + list(range(16, len(words), 16))
        cuts = [c for c in cuts if c < len(words)]
        parts = [" ".join(words[a:b]) for a, b in zip(cuts, cuts[1:] + [len(words)])]
        own = [blake2b(p.encode(), digest_size=8).hexdigest() for p in parts]
        if sections[-1] and int(sections[-1][-1], 16) % 4 == 0:
            sections.append([])
        sections[-1].append(digest(own))
        leaves += own
    return leaves, digest([digest(s) for s in sections])


def test_the_tree_follows_from_the_leaves(odd_rows):
    for _, text, *_ in odd_rows:
        print_ = fingerprint.fingerprint_of(text or "")
        leaves, root = plain_tree(text or "")
        version, told, body = print_.split(":", 2)
        assert re.split("[,/;]", body) == leaves and told == root
        assert fingerprint.is_sound(print_) and fingerprint.tree_of(print_)[0] == root
        wrong = body[:-1] + ("0" if body[-1] != "0" else "1")
        assert not fingerprint.is_sound(f"{version}:{told}:{wrong}")


def plain_likeness(a, b):
    """Two times the leaves that both have, by the leaves of both."""
    left, right = (Counter(plain_tree(t)[0]) for t in (a, b))
    both = sum((left & right).values())
    return 1.0 if a == b else min(2 * both / (left.total() + right.total()), 1 - 2**-20)


def test_likeness_counts_common_leaves(odd_rows):
    texts = [t or "" for _, t, *_ in odd_rows]
    prints = [fingerprint.fingerprint_of(t) for t in texts]
    for a, one in zip(texts, prints, strict=True):
        for b, two in zip(texts, prints, strict=True):
            assert fingerprint.likeness(one, two) == pytest.approx(plain_likeness(a, b), abs=1e-12)


def test_an_edit_is_located():
    lines = [f"line {k} with some words of its own {k * k}" for k in range(40)]
    changed = list(lines)
    changed[17] = "another line"
    a, b = (fingerprint.fingerprint_of("\n".join(x)) for x in (lines, changed))
    assert 0.8 < fingerprint.likeness(a, b) < 1
    ((section, paragraph),) = fingerprint.edits(a, b)
    sections = a.split(":", 2)[2].split(";")
    before = sum(len(s.split("/")) for s in sections[:section])
    assert before + paragraph == 17
    assert fingerprint.edits(a, a) == []


def test_edit_study(odd, odd_rows, none):
    got = fingerprint.edit_study(odd).collect()
    order = sorted(odd_rows, key=lambda r: (brute.key(r[0]), r[1] or ""))
    named = [r for r in order if r[0] is not None]
    expected = []
    for k, (i, t, *_) in enumerate(order):
        following = order[k + 1] if k + 1 < len(order) else named[0]
        t, other = t or "", following[1] or ""
        half = len(t) // 2
        expected.append((i, len(t), t[: len(t) - half] + other[:half]))
    assert bag(r[:3] for r in got) == bag(expected)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprint.edit_study(none).count() == 0


# --- secrets


def spans_of(scanned):
    return bag(
        (r.doc_id, tuple((s.start, s.kind, s.stop) for s in r.found if s.kind < 3))
        for r in scanned.collect()
    )


def test_base_secrets_of_odd_documents(spark, odd, odd_rows, none):
    assert spans_of(credentials.scan(odd)) == bag(
        (i, tuple(brute.base_spans(t))) for i, t, *_ in odd_rows
    )
    assert credentials.scan(none).count() == 0


TRICKY = [
    "token=token: abcdefgh", "password==x12345", "TOKEN='abcdef' api_key : \"zz.zz-zz\"", "secret=😀",
    "😀😀 token=abcdef 😀 " + "0" * 24, "AKIA" + "B" * 16 + "AKIA" + "C" * 15, "passwd:short secret=longer1",
    "token=secret=abcdef", "a" * 23 + " " + "b" * 30, "apikey=1234567" * 50, "tokén=abcdefg", "TOKEN =abcdefg",
]


def test_tricky_secrets(spark):
    rows = [(k, t) for k, t in enumerate(TRICKY)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert spans_of(credentials.scan(docs)) == bag((k, tuple(brute.base_spans(t))) for k, t in rows)
    got = {r.doc_id: r.text for r in credentials.redact(docs).collect()}
    assert got == {k: brute.redacted(t) for k, t in rows}


def test_weak_candidates_need_their_complements(spark):
    value = "Zb3kQ9xW7pLm2RtY5vN8cJ4h"
    rows = [
        (1, f"user: alice and the value {value}"),
        (2, f"user: alice {'far ' * 100} {value}"),
        (3, f"only {value} here"),
        (4, "user: alice alone"),
        (5, f"https://db.example.org/x user: alice {value}"),
        (6, f"https://db.example.org/x {value}"),
        (7, "login=bob token=abcdef1"),
        (None, f"user: alice and the value {value}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = {r.doc_id: r.spans for r in credentials.digests(credentials.scan(docs)).collect()}
    kinds = {k: [s.split(":")[0] for s in v.split(",") if s] for k, v in names.items()}
    assert kinds == {
        1: ["identifier", "value"], 2: [], 3: [], 4: [],
        5: ["endpoint", "identifier", "value"], 6: [], 7: ["identifier", "assign"],
        None: ["identifier", "value"],
    }


@pytest.mark.parametrize(
    "value",
    [
        "Zb3kQ9xW7pLm2RtY5vN8" * 4 + "Abcdef12==",  # an 88-character storage key and longer ones
        "Zb3kQ9xW7pLm2RtY5vN8" * 400,
        "Zb3kQ9xW-7pLm2RtY_5vN8cJ4h",  # the URL-safe alphabet
    ],
)
def test_values_of_any_length_and_alphabet(spark, value):
    text = f"account=alice1 {value} https://store.example.org/x"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = credentials.digests(credentials.scan(docs)).collect()
    at = text.index(value)
    assert f"value:{at}:{at + len(value)}" in row.spans.split(",")
    assert [s.split(":")[0] for s in row.spans.split(",")] == ["identifier", "value", "endpoint"]
    assert value not in credentials.redact(docs).first().text


def test_redaction_keeps_all_columns(odd, odd_rows):
    got = credentials.redact(odd)
    assert got.columns == odd.columns
    expected = []
    for i, t, lang, source, n in odd_rows:
        clean = t if t is None or not brute.base_spans(t) else brute.redacted(t)
        expected.append((i, clean, lang, source, n if clean == t else len(clean)))
    rows = got.select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert bag(rows) == bag(expected)
