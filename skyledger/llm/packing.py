"""Harmonic packing of tokenized documents into sequences of a fixed capacity.

Lengths fall into reciprocal-capacity classes: class ``i`` holds lengths in ``(C/(i+1), C/i]`` and
a bin of class ``i`` takes exactly ``i`` pieces, so that every worker fills the bins of each class
by itself, without knowing any other piece. Documents may be cut, so they are cut to the upper ends
of classes first: whole sequences, then halves, quarters and so on down to ``smallest``, which fill
their bins without a gap. Only the tail, shorter than ``smallest``, lies inside its class. What is
left in open bins at the end of a partition is packed first-fit by decreasing length, so a
partition leaves about one padded sequence.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from skyledger.llm.common import texts_of

CAPACITY = 2048
SMALLEST_CUT = 64
END_OF_DOCUMENT = 1
PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long,"
    " sequence_id long, offset long"
)
_ROWS = 2048


@cache
def _encoder(path: str) -> tuple[tiktoken.Encoding, Tokenizer, tuple[str, ...]]:
    """The vocabulary of a byte-level ``tokenizers`` file in a faster encoder, the tokenizer itself
    and the strings that it reads as special."""
    import json

    import public_tokenizers

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {token["content"] for token in model["added_tokens"]}
    byte_of = _byte_alphabet()
    ranks = {
        bytes(byte_of[c] for c in token): number
        for token, number in model["model"]["vocab"].items()
        if token not in special
    }
    fast = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return fast, tokenizer, tuple(special)


def _byte_alphabet() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary file means: printable Latin-1 characters
    mean themselves, the other bytes follow from 256 on in ascending order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def token_ids(text: str, path: str) -> list[int]:
    """Ids of ``tokenizers`` without special tokens added. A text that holds the string of a
    special token goes to ``tokenizers`` itself."""
    fast, tokenizer, special = _encoder(path)
    if any(s in text for s in special):
        return tokenizer.encode(text, add_special_tokens=False).ids
    return fast.encode_ordinary(text)


def cuts(tokens: int, capacity: int = CAPACITY, smallest: int = SMALLEST_CUT) -> list[int]:
    """Lengths of the pieces of a document, largest first."""
    whole, rest = divmod(tokens, capacity)
    lengths, size = [capacity] * whole, capacity
    while rest and size // 2 >= smallest:
        size //= 2
        if rest >= size:
            lengths.append(size)
            rest -= size
    while rest >= max(smallest, 1) and rest > size:  # a capacity that is no power of two
        lengths.append(size)
        rest -= size
    return lengths + [rest] * bool(rest)


class Packer:
    """Places pieces as they come; ``place`` and ``finish`` yield ``(piece, sequence, offset)``."""

    def __init__(self, capacity: int = CAPACITY, first_sequence: int = 0):
        self.capacity = capacity
        self.next_sequence = first_sequence
        self.open: dict[int, list[tuple[int, object]]] = {}

    def _close(self, members: list[tuple[int, object]]) -> Iterator[tuple[object, int, int]]:
        offset = 0
        for length, piece in members:
            yield piece, self.next_sequence, offset
            offset += length
        self.next_sequence += 1

    def place(self, length: int, piece: object) -> Iterator[tuple[object, int, int]]:
        kind = self.capacity // length
        members = self.open.setdefault(kind, [])
        members.append((length, piece))
        if len(members) == kind:
            del self.open[kind]
            yield from self._close(members)

    def finish(self) -> Iterator[tuple[object, int, int]]:
        rest = sorted((m for b in self.open.values() for m in b), key=lambda m: -m[0])
        self.open = {}
        bins: list[list[tuple[int, object]]] = []
        room: list[int] = []
        first = 0  # bins before it are full
        for length, piece in rest:
            at = next((i for i in range(first, len(bins)) if room[i] >= length), None)
            if at is None:
                at = len(bins)
                bins.append([])
                room.append(self.capacity)
            bins[at].append((length, piece))
            room[at] -= length
            while first < len(bins) and room[first] == 0:
                first += 1
        for members in bins:
            yield from self._close(members)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    smallest: int = SMALLEST_CUT,
    end_id: int = END_OF_DOCUMENT,
) -> DataFrame:
    """One row per piece of a document, with its ids as little-endian unsigned 32-bit integers.

    A null or empty text is the end id alone. Repeated rows are packed each; a null ``doc_id``
    stays null. An empty table gives no pieces. Pieces of one sequence come from one partition, so
    no row is shuffled and a lost partition is packed again by itself.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        partition = context.partitionId() if context else 0
        packer = Packer(capacity, partition << 40)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            types = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for incoming in batches:
            ids_of_docs = incoming.column("doc_id").to_pylist()
            for doc_id, text in zip(ids_of_docs, incoming.column("text"), strict=True):
                ids = token_ids(text.as_py(), tokenizer_path)
                ids.append(end_id)
                raw, start = np.array(ids, "<u4").tobytes(), 0
                for length in cuts(len(ids), capacity, smallest):
                    data = raw[4 * start : 4 * (start + length)]
                    piece = (doc_id, start, length, data, len(ids))
                    start += length
                    rows.extend((*p, s, o) for p, s, o in packer.place(length, piece))
                if len(rows) >= _ROWS:
                    yield batch()
        rows.extend((*p, s, o) for p, s, o in packer.finish())
        if rows:
            yield batch()

    return texts_of(docs).mapInArrow(run, PIECES)
