"""Best-two-fit packing of tokenized documents into as few sequences as it can.

A sequence is filled greedily, the longest piece that fits first. Then its shortest piece makes room
for the two unpacked pieces that together fill the wider gap best, if they fill more than it did.
A worker packs a pool of some million tokens at a time; sequences that stay loose go back into the
next pool. Nothing is shuffled.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from skyledger.llm.common import binary_column, text_groups, texts_of

CAPACITY = 4096
END_OF_DOCUMENT = 1
#: Tokens that a worker holds to choose from, and what a sequence may lack to be given out at once.
POOL_TOKENS = 4 << 20
LOOSE = 1 / 256
PIECES = (
    "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
)
_ROWS = 2048
_KNOWN_WORDS = 1_000_000
_WIDTH = 4
#: Leading bytes of combining marks that join an ASCII letter to one character.
_MARK = re.compile(rb"[\xcc\xcd]")
#: Punctuation, but for apostrophes, between an ASCII letter and white space.
_BEHIND = re.compile(rb"(?<=[a-z])[!-&(-/:-@\[-`{-~]+(?=[ \t\n\r\x0b\x0c]|\Z)")
#: Lower-case letters of ASCII and Latin-1, in UTF-8.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


# --- tokens


class Words:
    """Ids of ``tokenizers``, with the ids of words that came before looked up.

    A word is what stands between ASCII white space, where the tokenizer always splits; it
    normalises character by character or together with marks that follow, so that a word has the
    same ids wherever it stands. Texts in which no mark can follow a capital are put in lower case
    first and marks of punctuation behind a word are taken off it, as the tokenizer does, so that
    fewer words are new. Words of lower-case letters skip its normalisation and splitting.
    """

    def __init__(self, path: str):
        # a task has one core
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self._whole = Tokenizer.from_str(json.dumps(settings))
        self._special = [t["content"].encode() for t in settings["added_tokens"]]
        by_byte = [p for p in settings["pre_tokenizer"]["pretokenizers"] if p["type"] == "ByteLevel"]
        plain = settings | {"normalizer": None, "pre_tokenizer": by_byte[0], "added_tokens": []}
        self._letters = Tokenizer.from_str(json.dumps(plain))
        self._known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes], tokenizer: Tokenizer) -> None:
        if not words:
            return
        texts = b"\n".join(words).decode().split("\n")
        found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        raw = np.fromiter(chain.from_iterable(found), "<u4").tobytes()
        ends = list(accumulate(_WIDTH * len(ids) for ids in found))
        for word, start, end in zip(words, [0, *ends], ends):
            self._known[word] = raw[start:end]

    def _split(self, text: bytes) -> list[bytes]:
        lower = text.lower()  # of ASCII letters
        if _MARK.search(text) or any(s in lower for s in self._special):
            return text.split()
        return _BEHIND.sub(rb" \g<0>", lower).split()

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self._split(t) for t in texts]
        used = set().union(*split)
        new = used.difference(self._known)
        if len(self._known) + len(new) > _KNOWN_WORDS:  # remember what is used now
            self._known = {w: self._known[w] for w in used.difference(new)}
        letters = [w for w in new if _LETTERS.fullmatch(w)]
        self._learn(letters, self._letters)
        self._learn(list(new.difference(letters)), self._whole)
        return [b"".join(map(self._known.__getitem__, words)) for words in split]


@cache
def _words(path: str) -> Words:
    return Words(path)


# --- packing


class Pool:
    """Unpacked pieces by length, and sequences filled from them."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.pieces: list[list] = [[] for _ in range(capacity + 1)]
        self.count = np.zeros(capacity + 1, np.int64)
        self.tokens = 0

    def add(self, length: int, piece: object) -> None:
        self.pieces[length].append(piece)
        self.count[length] += 1
        self.tokens += length

    def _take(self, length: int) -> tuple[int, object]:
        self.count[length] -= 1
        self.tokens -= length
        return length, self.pieces[length].pop()

    def _longest(self) -> np.ndarray:
        """For every gap the longest length there is that fits, else 0."""
        lengths = np.arange(self.capacity + 1)
        return np.maximum.accumulate(np.where(self.count > 0, lengths, 0))

    def _two(self, gap: int) -> tuple[int, int]:
        """Two lengths with the largest sum up to ``gap``; zeros if no two fit."""
        fits = self._longest()
        longer = np.flatnonzero(self.count[: gap + 1])
        shorter = fits[np.minimum(longer, gap - longer)]
        # one piece is not two
        alone = (shorter == longer) & (self.count[longer] < 2)
        shorter = np.where(alone, fits[np.maximum(longer - 1, 0)], shorter)
        sums = np.where(shorter > 0, longer + shorter, 0)
        if not len(sums) or not sums.max():
            return 0, 0
        best = int(np.argmax(sums))
        return int(longer[best]), int(shorter[best])

    def sequence(self) -> tuple[list[tuple[int, object]], int]:
        """The next sequence and the tokens that it lacks; there must be a piece."""
        members, gap = [], self.capacity
        fits = self._longest()
        while gap and (length := int(fits[gap])):
            members.append(self._take(length))
            gap -= length
            if not self.count[length]:
                fits = self._longest()
        if gap and len(members) > 1:
            shortest = members[-1][0]
            pair = self._two(gap + shortest)
            if sum(pair) > shortest:
                self.add(*members.pop())
                members += [self._take(length) for length in pair]
                gap += shortest - sum(pair)
        return members, gap


class Packer:
    """Collects pieces and gives sequences out, lists of ``(length, piece)``."""

    def __init__(self, capacity: int = CAPACITY, pool_tokens: int = POOL_TOKENS):
        self.pool = Pool(capacity)
        self.pool_tokens = pool_tokens

    def place(self, length: int, piece: object) -> Iterator[list[tuple[int, object]]]:
        if length == self.pool.capacity:
            yield [(length, piece)]
            return
        self.pool.add(length, piece)
        if self.pool.tokens >= self.pool_tokens:
            yield from self._emptied()

    def _emptied(self) -> Iterator[list[tuple[int, object]]]:
        """All sequences; loose ones return to the pool unless they would fill half of it."""
        loose, kept = [], 0
        while self.pool.tokens:
            members, gap = self.pool.sequence()
            if gap > LOOSE * self.pool.capacity and kept < self.pool_tokens // 2:
                loose += members
                kept += self.pool.capacity - gap
            else:
                yield members
        for length, piece in loose:
            self.pool.add(length, piece)

    def finish(self) -> Iterator[list[tuple[int, object]]]:
        while self.pool.tokens:
            yield self.pool.sequence()[0]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_OF_DOCUMENT,
    pool_tokens: int = POOL_TOKENS,
) -> DataFrame:
    """One row per piece of a document, with its ids as little-endian unsigned 32-bit integers.

    Only documents longer than ``capacity`` are cut. A null or empty text is the end id alone.
    Repeated rows are packed each; a null ``doc_id`` stays null. An empty table gives no pieces.
    Sequences are those of one partition, which a lost executor packs again in the same way.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 40
        words, packer = _words(tokenizer_path), Packer(capacity, pool_tokens)
        end = np.array([end_id], "<u4").tobytes()
        rows: list[tuple] = []
        number = first

        def given(sequences: Iterable[list[tuple[int, object]]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for members in sequences:
                offset = 0
                for length, piece in members:
                    rows.append((*piece, number, offset))
                    offset += length
                number += 1
                if len(rows) >= _ROWS:
                    yield batch()

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            names = ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for incoming in batches:
            for part in text_groups(incoming):
                doc_ids = part.column("doc_id").to_pylist()
                texts = words.ids(binary_column(part, "text"))
                for doc_id, ids in zip(doc_ids, texts, strict=True):
                    ids += end
                    step = _WIDTH * capacity
                    for piece, at in enumerate(range(0, len(ids), step)):
                        data = ids[at : at + step]
                        length = len(data) // _WIDTH
                        row = (doc_id, piece, at // _WIDTH, length, data)
                        yield from given(packer.place(length, row))
        yield from given(packer.finish())
        if rows:
            yield batch()

    return texts_of(docs).mapInArrow(run, PIECES)
