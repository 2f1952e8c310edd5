"""Byte-level BPE by merge replay over the vocabulary of a corpus.

The words of a split (matches of the pattern) are laid out once each in one array of token ids with
links to the neighbours. An inverted index maps each pair of adjacent tokens to the positions where
it stands. Merges are applied in rank order, each at all of its positions at once, and only the
pairs with the touched neighbours are indexed anew. This gives each word the ids that merging the
lowest-ranked pair of the word again and again would give, since a merge only ever makes pairs of
a higher rank.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from skyledger.llm.common import map_batches, texts_of

#: Words that a worker remembers, and new words whose merges are replayed together.
REMEMBERED_WORDS = 500_000
WORDS_AT_ONCE = 150_000

#: The pattern of the public vocabularies (a fixed value), and what it means for texts below U+0250, where letters,
#: digits and white space are a few ranges and the plain expression module is faster.
PUBLIC_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_BLANK = "\t-\r \x85\xa0"
_BELOW = "\u0250"
LATIN_PATTERN = (
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+"
    f"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)


class Vocabulary:
    """Ranks of byte strings, and the merge that makes each of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.bytes_of = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # every split of a token into two tokens is a pair that merges into it
        pairs, results = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs.append(left * self.size + right)
                    results.append(rank)
        order = np.argsort(np.array(pairs, np.int64))
        self.pairs = np.array(pairs, np.int64)[order]
        self.results = np.array(results, np.int64)[order]

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids that the pairs merge into, ``size`` where they do not merge."""
        if not len(self.pairs):
            return np.full(len(left), self.size, np.int64)
        codes = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
        return np.where(self.pairs[at] == codes, self.results[at], self.size)


@cache
def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as file:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})


def _alternate(positions: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of positions whose pairs overlap (a pair of equal tokens in a run), every other one from the
    start of each run."""
    chained = np.empty(len(positions), bool)
    chained[0] = False
    chained[1:] = following[positions[:-1]] == positions[1:]
    if not chained.any():
        return positions
    index = np.arange(len(positions))
    run_start = np.maximum.accumulate(np.where(chained, 0, index))
    return positions[(index - run_start) % 2 == 0]


def replay(words: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """Ids of each word as little-endian unsigned 32-bit integers."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    token = vocab.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    n = len(token)
    if not n:
        return [b""] * len(words)
    following = np.arange(1, n + 1)
    following[(starts + lengths - 1)[lengths > 0]] = n  # n: no neighbour
    previous = np.arange(-1, n - 1)
    previous[starts[lengths > 0]] = n
    token = np.append(token, -1)
    previous, following = np.append(previous, n), np.append(following, n)
    alive = np.ones(n + 1, bool)
    alive[n] = False

    index: dict[int, list[np.ndarray]] = {}  # by the rank of the merge: positions of left tokens
    heap: list[int] = []

    def add(positions: np.ndarray) -> None:
        if not len(positions):
            return
        ranks = vocab.merged(token[positions], token[following[positions]])
        known = ranks < vocab.size
        positions, ranks = positions[known], ranks[known]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        bounds = np.flatnonzero(np.diff(ranks)) + 1
        for rank, part in zip(
            ranks[np.append(0, bounds)].tolist(), np.split(positions, bounds), strict=True
        ):
            if rank in index:
                index[rank].append(part)
            else:
                index[rank] = [part]
                heapq.heappush(heap, rank)

    add(np.flatnonzero(following[:n] < n))
    while heap:
        rank = heapq.heappop(heap)
        parts = index.pop(rank)
        at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        at = at[alive[at]]
        right = following[at]
        at = at[(right < n) & (vocab.merged(token[at], token[right]) == rank)]
        if not len(at):
            continue
        # one token can be split in several ways; the ways may overlap, so go from the left
        at = _alternate(at, following)
        right = following[at]
        after = following[right]
        token[at] = rank
        alive[right] = False
        following[at] = after
        previous[after[after < n]] = at[after < n]
        add(np.unique(np.concatenate([previous[at][previous[at] < n], at[after < n]])))
    alive = alive[:n]
    per_word = np.add.reduceat(alive, np.minimum(starts, n - 1)) if len(words) else lengths
    per_word = np.where(lengths > 0, per_word, 0)
    raw = token[:n][alive].astype("<u4").tobytes()
    ends = (np.cumsum(per_word) * 4).tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


#: A character that is no letter, number or space in any version of the character database.
_OTHER = 0xFFFE


@cache
def _classless() -> frozenset[str]:
    """Characters that the ``regex`` module takes for letters or numbers and the library for neither;
    newer versions of the standard give more characters a class.

    Only characters that the database of this Python does not know can be such. The library splits
    one from a letter and a digit, so that it does not use the token of both.
    """
    found = regex.compile(r"[\p{L}\p{N}]")
    unknown = [
        c for c in map(chr, range(0x250, 0x110000))
        if unicodedata.category(c) == "Cn" and found.match(c)
    ]
    tokens = {bytes([b]): b for b in range(256)}
    for pair in (before + c for c in unknown for before in "a1"):
        tokens[pair.encode()] = len(tokens)
    probe = tiktoken.Encoding(
        "probe", pat_str=PUBLIC_PATTERN, mergeable_ranks=tokens, special_tokens={}
    )
    return frozenset(
        c for c in unknown if all(len(probe.encode_ordinary(b + c)) > 1 for b in "a1")
    )


def _split_as_library(pattern: str) -> Callable[[str], list[str]]:
    """All matches of the pattern, with letters and numbers as the library knows them."""
    compiled = regex.compile(pattern)

    def split(text: str) -> list[str]:
        if _classless().isdisjoint(text):
            return compiled.findall(text)
        hidden = {ord(c): _OTHER for c in _classless().intersection(text)}
        return [text[m.start() : m.end()] for m in compiled.finditer(text.translate(hidden))]

    return split


class Encoder:
    """Encodes texts in groups, replaying the merges of words not seen before."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED_WORDS):
        self.vocab = vocabulary(path)
        self.split = _split_as_library(pattern)
        if pattern == PUBLIC_PATTERN:
            latin, other = re.compile(LATIN_PATTERN).findall, self.split
            self.split = lambda text: (latin if max(text, default="") < _BELOW else other)(text)
        self.remembered = remembered
        self.ids: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self.ids) + len(words) > self.remembered:
            self.ids.clear()
        new = sorted(words)
        self.ids.update(zip(new, replay([w.encode() for w in new], self.vocab), strict=True))

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text; words wait until enough new ones are there to be replayed together."""
        waiting: list[list[str]] = []
        new: set[str] = set()
        count = 0
        for text in texts:
            words = self.split(text)
            waiting.append(words)
            count += len(words)
            new.update(words)
            if len(new) >= WORDS_AT_ONCE or count >= 8 * WORDS_AT_ONCE:
                yield from self._flush(waiting, new)
                waiting, new, count = [], set(), 0
        yield from self._flush(waiting, new)

    def _flush(self, waiting: list[list[str]], new: set[str]) -> Iterator[bytes]:
        unknown = new.difference(self.ids)
        if len(self.ids) + len(unknown) > self.remembered:
            self.ids.clear()
            unknown = new
        self._learn(unknown)
        get = self.ids.__getitem__
        for words in waiting:
            yield b"".join(map(get, words))


@cache
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _decoded(ids: bytes, vocab: Vocabulary) -> bytes:
    return b"".join(map(vocab.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(
    docs: DataFrame, ranks_path: str, pattern: str = PUBLIC_PATTERN, decoded: bool = False
) -> DataFrame:
    """``doc_id`` and ``ids`` (binary, little-endian unsigned 32-bit) of every whole text, and with
    ``decoded`` what the ids decode to (binary), as ``decode`` gives in a further pass.

    A null or empty text has no ids. Repeated rows are encoded each; a null ``doc_id`` stays null.
    Nothing is shuffled: each split replays the merges of its own words, and a worker keeps the
    words of earlier splits up to a bound.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids: list = []

        def texts() -> Iterator[str]:
            for batch in batches:
                doc_ids.extend(batch.column("doc_id").to_pylist())
                for text in batch.column("text"):
                    yield text.as_py()

        rows: list[bytes] = []
        names = ["doc_id", "ids", *["decoded"] * decoded]
        done = size = 0

        def batch() -> pa.RecordBatch:
            nonlocal done, size
            part = doc_ids[done : done + len(rows)]
            columns = [pa.array(part, pa.int64()), pa.array(rows, pa.binary())]
            if decoded:
                vocab = vocabulary(ranks_path)
                columns.append(pa.array([_decoded(ids, vocab) for ids in rows], pa.binary()))
            result = pa.RecordBatch.from_arrays(columns, names)
            done, size = done + len(rows), 0
            rows.clear()
            return result

        for ids in _encoder(ranks_path, pattern).encode(texts()):
            rows.append(ids)
            size += len(ids)
            if size >= 8 << 20 or len(rows) >= 5000:
                yield batch()
        if rows:
            yield batch()

    schema = "doc_id long, ids binary" + ", decoded binary" * decoded
    return texts_of(docs).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the bytes that the ids stand for (null ids: empty)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocab = vocabulary(ranks_path)
        decoded = [_decoded(ids.as_py() or b"", vocab) for ids in batch.column("ids")]
        doc_id, ids = batch.column("doc_id"), batch.column("ids")
        return pa.RecordBatch.from_arrays(
            [doc_id, ids, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"]
        )

    return map_batches(
        encoded.select("doc_id", "ids"), run, "doc_id long, ids binary, decoded binary"
    )
