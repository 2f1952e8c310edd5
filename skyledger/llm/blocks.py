"""Texts in blocks of bounded size, and exchanges of packed arrays between blocks and slices.

A block holds whole documents, dealt by a hash of the id, the text and the place of the row in its
table, so that no id and no number of equal rows can make one block large. The table must give its rows in one
order when it is read again, as files do. What
blocks have to tell each other (hashes of windows, counts) goes as packed arrays, one row per block
and slice of the key space, to the task of the slice and, aligned with what was sent, back to the
block. Keys are counted once per block before they travel, so a frequent key adds one entry per
block at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.llm.common import (
    TASK_BYTES,
    binary_column,
    mixed,
    shuffle_partitions,
    text_columns,
    total_bytes,
)

NO_ID = -(2**63)
_U = np.uint64


#: Bytes of text in a block, and bytes of text per slice of what blocks exchange. Both follow the
#: size of the corpus; a block and a slice exchange at most one row, and only if they share a key.
BLOCK_BYTES = 1 << 20
SLICE_BYTES = 8 << 20
LEAST_BLOCKS = 8


# --- packed arrays


def pack(values: np.ndarray) -> bytes:
    """Any integers, by byte planes: the high bytes of close values compress to nothing."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(blob: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


def pack_sorted(values: np.ndarray, dtype=np.uint32) -> bytes:
    """Ascending integers as differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)).astype(dtype))


def unpack_sorted(blob: bytes, dtype=np.uint32) -> np.ndarray:
    return np.cumsum(unpack(blob, dtype), dtype=np.int64)


# --- hashes of ranges of an array


@cache
def _seeds(which: int) -> tuple[np.ndarray, int]:
    random = np.random.default_rng(1000 + which)
    table = random.integers(0, 2**64, 256, dtype=np.uint64)
    return table, int(random.integers(2**32, 2**63)) * 2 + 1


#: Longer words are hashed one by one: a polynomial modulo a power of two has equal values for long
#: words that can be built against it, whatever its base.
SHORT_WORD = 24
#: Bytes whose 64-bit hashes are worked on together.
CACHED_BYTES = 1 << 16

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _base_powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if which not in _powers or len(_powers[which][0]) < n:
        base = _seeds(which)[1]
        both = []
        for b in (base, pow(base, -1, 2**64)):
            row = np.full(n, b % 2**64, np.uint64)
            row[0] = 1
            both.append(np.cumprod(row, dtype=np.uint64))
        _powers[which] = (both[0], both[1])
    return _powers[which]


class RangeHash:
    """Polynomial hash of any range of ``values`` (64-bit integers) in constant time."""

    def __init__(self, values: np.ndarray, which: int):
        up, self._down = _base_powers(which, len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self._sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mixed((self._sums[stops] - self._sums[starts]) * self._down[starts])

    def rolling(self, length: int) -> np.ndarray:
        n = len(self._sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self._sums[length:] - self._sums[:n]) * self._down[:n])


def byte_values(data: np.ndarray, which: int) -> np.ndarray:
    return _seeds(which)[0][data]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Texts:
    """Texts in one buffer: ``data`` holds them all, a line break after each; ``starts`` and
    ``lengths`` tell where. Words are runs of bytes outside ``separators``."""

    def __init__(self, texts: list[bytes], separators: np.ndarray = _SPACE):
        self.texts = texts
        self.separators = separators
        self.data = np.frombuffer(b"".join(x for t in texts for x in (t, b"\n")), np.uint8)
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1

    def __len__(self) -> int:
        return len(self.texts)

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, stop and document of each word."""
        apart = self.separators[self.data]
        before = np.concatenate([[True], apart[:-1]])
        after = np.concatenate([apart[1:], [True]])
        starts = np.flatnonzero(~apart & before)
        stops = np.flatnonzero(~apart & after) + 1
        return starts, stops, np.searchsorted(self.starts, starts, "right") - 1

    def word_hashes(self, which: int, lower: bool = False) -> np.ndarray:
        """Hash of each word; ``lower`` reads A-Z as a-z."""
        values = _seeds(which)[0][_LOWER] if lower else _seeds(which)[0]
        starts, stops, _ = self.words
        result = np.empty(len(starts), np.uint64)
        # in pieces that stay in the processor's cache
        cuts = np.unique(np.searchsorted(starts, np.arange(0, len(self.data), CACHED_BYTES)))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(starts)], strict=True):
            if a < b:
                low, high = starts[a], stops[b - 1]
                hashes = RangeHash(values[self.data[low:high]], which)
                result[a:b] = hashes.of(starts[a:b] - low, stops[a:b] - low)
        for i in np.flatnonzero(stops - starts > SHORT_WORD).tolist():
            word = self.data[starts[i] : stops[i]]
            result[i] = xxhash.xxh3_64_intdigest((_LOWER[word] if lower else word).tobytes(), which)
        return result


class TextBlock(Texts):
    """The documents of a block in the order of their ids (null first), then texts."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").to_pylist()
        texts = binary_column(table, "text")
        order = sorted(
            range(len(ids)), key=lambda i: (NO_ID if ids[i] is None else ids[i], texts[i])
        )
        self.doc_ids = [ids[i] for i in order]
        self.ids = np.array([NO_ID if x is None else x for x in self.doc_ids], np.int64)
        self.carried = table.column("carried").take(pa.array(order, pa.int64())).combine_chunks()
        super().__init__([texts[i] for i in order])


# --- blocks of a table


@dataclass
class Blocks:
    frame: DataFrame  # doc_id, text, block
    n_blocks: int
    n_parts: int
    total_bytes: int

    @property
    def n_slices(self) -> int:
        return max(LEAST_BLOCKS, -(-self.total_bytes // SLICE_BYTES))

    def each(self, function: Callable[[TextBlock], Iterator[dict]], schema: Schema) -> DataFrame:
        """Rows that ``function`` gives for each block; it yields columns."""

        def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            return _table(function(TextBlock(table), key[0].as_py()), schema)

        return self.frame.groupBy("block").applyInArrow(run, schema)

    def with_answers(
        self, answers: DataFrame, function: Callable[[TextBlock, pa.Table], Iterator], schema: Schema
    ) -> DataFrame:
        """As ``each``, with the rows of ``answers`` for the block."""

        def run(key: tuple[pa.Scalar, ...], table: pa.Table, rows: pa.Table) -> pa.Table:
            if not table.num_rows:
                return _table([], schema)
            return _table(function(TextBlock(table), key[0].as_py(), rows), schema)

        answered = answers.repartition(self.n_parts, "block").groupBy("block")
        return self.frame.groupBy("block").cogroup(answered).applyInArrow(run, schema)


#: The columns of a result, as text or as Spark holds them.
Schema = str | T.StructType


def _arrow_schema(schema: Schema) -> pa.Schema:
    if isinstance(schema, T.StructType):
        return to_arrow_schema(schema)
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
        "binary": pa.binary(), "boolean": pa.bool_(),
    }
    fields = (f.split() for f in schema.split(","))
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def _column(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def _table(rows, schema: Schema) -> pa.Table:
    """One table out of dictionaries of columns."""
    target = _arrow_schema(schema)
    parts = [
        pa.table([_column(part[f.name], f.type) for f in target], schema=target) for part in rows
    ]
    return pa.concat_tables(parts) if parts else target.empty_table()


def blocks_of(docs: DataFrame, carry: tuple[str, ...] = ()) -> Blocks:
    """Deals the documents out. A null text counts as empty. Columns to ``carry`` go along as a
    struct."""
    carried = F.struct(*carry) if carry else F.lit(None).cast("string")
    texts = docs.select(*text_columns(), carried.alias("carried"))
    size = total_bytes(texts)
    n_parts = max(shuffle_partitions(docs.sparkSession), -(-size // TASK_BYTES))
    n_blocks = max(LEAST_BLOCKS, -(-size // BLOCK_BYTES))
    key = F.xxhash64("doc_id", F.xxhash64("text"), F.monotonically_increasing_id())
    frame = texts.withColumn("block", F.pmod(key, F.lit(n_blocks)))
    return Blocks(frame.repartition(n_parts, "block"), n_blocks, n_parts, size)


# --- exchange by slices


def by_slice(
    slices: np.ndarray, n_slices: int, columns: dict[str, np.ndarray]
) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Parts of the columns by ascending ``slices``."""
    bounds = np.searchsorted(slices, np.arange(n_slices + 1))
    for i in np.flatnonzero(np.diff(bounds)).tolist():
        yield i, {k: v[bounds[i] : bounds[i + 1]] for k, v in columns.items()}


def per_slice(
    sent: DataFrame,
    n_slices: int,
    function: Callable[[int, dict[str, list]], Iterator[dict]],
    schema: str,
) -> DataFrame:
    """``function`` on all rows of each slice, as lists of columns. There are as many tasks as slices
    at least, so that a task does not grow with their number."""
    n_parts = max(shuffle_partitions(sent.sparkSession), n_slices)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _table(function(key[0].as_py(), table.to_pydict()), schema)

    return sent.repartition(n_parts, "slice").groupBy("slice").applyInArrow(run, schema)


# --- count-min sketch

SLICE_BITS = 24
#: Cells of a row of the sketch per key, so that few keys share both their cells.
CELLS_PER_KEY = 4


@dataclass(frozen=True)
class Sketch:
    """A count-min sketch whose rows are cut into slices of cells, one task each.

    Every block counts its keys by cell and sends the counts of a slice to its task; the merged
    counts of its cells come back. The estimate of a key is the least of its cells, never less than
    its true count. The width follows the number of keys, as does the number of slices, so neither
    the precision nor the memory of a task depends on the size of the corpus.
    """

    bits: int
    depth: int = 2

    @staticmethod
    def for_keys(n_keys: int) -> Sketch:
        return Sketch(max(16, int(CELLS_PER_KEY * max(n_keys, 1) - 1).bit_length()))

    @property
    def slice_bits(self) -> int:
        return min(SLICE_BITS, self.bits)

    def cells(self, keys: np.ndarray, row: int) -> np.ndarray:
        hashed = keys if row == 0 else mixed(keys + _U(0x9E3779B97F4A7C15) * _U(row))
        return (hashed >> _U(64 - self.bits)).astype(np.int64) + (row << self.bits)

    def _sent(self, block: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[dict]:
        for row in range(self.depth):
            cells = self.cells(keys, row)
            order = np.argsort(cells, kind="stable") if row else slice(None)
            cells, own = cells[order], counts[order]
            first = np.flatnonzero(np.diff(cells, prepend=-1))
            cells, own = cells[first], np.add.reduceat(own, first)
            base = row << (self.bits - self.slice_bits)
            n = 1 << (self.bits - self.slice_bits)
            parts = by_slice((cells >> self.slice_bits) - base, n, {"c": cells, "n": own})
            for i, part in parts:
                yield {
                    "slice": [base + i],
                    "block": [block],
                    "cells": [pack_sorted(part["c"] & ((1 << self.slice_bits) - 1))],
                    "counts": [pack(np.minimum(part["n"], 65535).astype(np.uint16))],
                }

    def merge(self, blocks: Blocks, keys_of: Callable[[TextBlock], np.ndarray]) -> DataFrame:
        """``block``, ``slice``, ``answer``: merged counts of the cells that the block has there.

        ``keys_of`` gives the keys of a block, one per occurrence.
        """

        def send(block: TextBlock, number: int) -> Iterator[dict]:
            keys, counts = np.unique(keys_of(block), return_counts=True)
            if len(keys):
                yield from self._sent(number, keys, counts)

        def add(_: int, rows: dict[str, list]) -> Iterator[dict]:
            total = np.zeros(1 << self.slice_bits, np.uint32)
            cells = [unpack_sorted(c) for c in rows["cells"]]
            for c, n in zip(cells, rows["counts"], strict=True):
                total[c] += unpack(n, np.uint16)
            answers = [pack(np.minimum(total[c], 65535).astype(np.uint16)) for c in cells]
            yield {"block": rows["block"], "slice": rows["slice"], "answer": answers}

        sent = blocks.each(send, "slice long, block long, cells binary, counts binary")
        n_slices = self.depth << (self.bits - self.slice_bits)
        return per_slice(sent, n_slices, add, "block long, slice long, answer binary")

    def estimates(self, keys: np.ndarray, answers: pa.Table) -> np.ndarray:
        """Estimated count of each of the ascending, distinct ``keys`` of the block."""
        order = np.argsort(answers.column("slice").to_numpy())
        blobs = answers.column("answer").to_pylist()
        merged = [unpack(blobs[i], np.uint16) for i in order.tolist()]
        merged = np.concatenate(merged) if merged else np.zeros(0, np.uint16)
        result = np.full(len(keys), 65535, np.uint16)
        done = 0
        for row in range(self.depth):
            cells = self.cells(keys, row)
            order = np.argsort(cells, kind="stable") if row else np.arange(len(cells))
            rank = np.cumsum(np.diff(cells[order], prepend=-1) != 0) - 1
            result[order] = np.minimum(result[order], merged[done + rank])
            done += rank[-1] + 1 if len(rank) else 0
        return result
