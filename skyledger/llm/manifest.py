"""A Merkle manifest of a table of documents, with a witness for every row.

Leaves are appended in order to a tree whose runs of eight nodes become one. A subtree that joins an
open run gets a partial witness, its siblings so far; every later sibling that completes extends
the witnesses of those before it, and a full run moves up as one subtree. Blocks of 8**4 nodes that
are aligned to whole subtrees are appended to by tasks of their own, and their roots are the nodes
of the next round, until a tree has one node. Each language has its tree; their roots, in the order
of the languages, are the nodes of one more.

Only digests and ids are shuffled, never a text. Places in a tree come from a sort by ranges and a
count per partition, so a language with most rows is spread like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.llm.common import shuffle_partitions, write_counted, write_scratch

RUN = 8
#: A block has RUN ** BLOCK_LEVELS nodes.
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes in a partition of the sort, and in a batch that a task returns.
NODES_PER_TASK = 500_000
_NODES_AT_ONCE = 4096


# --- one tree, node by node


class _Subtree:
    """A subtree and its witness on the level where it has siblings: those before it are known when
    it is appended, those after it come later."""

    __slots__ = ("node", "before", "after", "parent")

    def __init__(self, node: bytes, before: bytes):
        self.node, self.before = node, before
        self.after = bytearray()
        self.parent: _Subtree | None = None


def _hex_digest(data: bytes) -> bytes:
    """SHA-256 of binary digests taken as hexadecimal text."""
    return hashlib.sha256(data.hex().encode()).digest()


class Appender:
    """A tree that grows by one node at a time and keeps a witness per node."""

    def __init__(self):
        self.nodes: list[_Subtree] = []
        self._open: list[list[_Subtree]] = [[]]

    def append(self, node: bytes) -> None:
        self.nodes.append(self._joined(0, node))

    def _joined(self, level: int, node: bytes) -> _Subtree:
        if level == len(self._open):
            self._open.append([])
        run = self._open[level]
        new = _Subtree(node, b"".join(x.node for x in run))
        for earlier in run:
            earlier.after += node
        run.append(new)
        if len(run) == RUN:
            self._complete(level)
        return new

    def _complete(self, level: int) -> None:
        run, self._open[level] = self._open[level], []
        parent = self._joined(level + 1, _hex_digest(b"".join(x.node for x in run)))
        for member in run:
            member.parent = parent

    def close(self, height: int) -> bytes:
        """Completes the runs that are still open below ``height``; the one node left there."""
        for level in range(height):
            if len(self._open) > level and self._open[level]:
                self._complete(level)
        return self._open[height][0].node

    def witnesses(self, height: int) -> tuple[list[bytes], list[bytes]]:
        """Siblings before and after, node by node and from the lowest level up."""
        before, after = [], []
        for subtree in self.nodes:
            for _ in range(height):
                before.append(subtree.before)
                after.append(bytes(subtree.after))
                subtree = subtree.parent
        return before, after


def height_of(size: int, most: int) -> int:
    """Levels up to ``most`` that ``size`` nodes need to become one."""
    height = 0
    while RUN**height < size and height < most:
        height += 1
    return height


# --- all trees of a table

_WITNESS = "array<struct<before: binary, after: binary>>"


def _witness_array(before: list[bytes], after: list[bytes], levels: list[int]) -> pa.Array:
    pairs = pa.StructArray.from_arrays(
        [pa.array(before, pa.binary()), pa.array(after, pa.binary())], ["before", "after"]
    )
    offsets = np.concatenate([[0], np.cumsum(levels)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


class _Blocks:
    """Appends the rows of a task, which come by tree and place, and gives them back with the
    witness inside their block and its root."""

    def __init__(self, levels: int):
        self.most = levels
        self.rows: list[pa.RecordBatch] = []  # given to the block that is open
        self.done: list[pa.RecordBatch] = []
        self.before: list[bytes] = []
        self.after: list[bytes] = []
        self.levels: list[int] = []
        self.tops: list[bytes] = []
        self.key: tuple | None = None
        self.tree = Appender()

    def add(self, key: tuple, size: int, rows: pa.RecordBatch) -> None:
        if key != self.key:
            self.close()
            self.key, self.size = key, size
        for node in rows.column("node").to_pylist():
            self.tree.append(node)
        self.rows.append(rows)

    def close(self) -> None:
        if self.key is None:
            return
        height, n = height_of(self.size, self.most), len(self.tree.nodes)
        top = self.tree.close(height)
        before, after = self.tree.witnesses(height)
        self.before += before
        self.after += after
        self.levels += [height] * n
        self.tops += [top] * n
        self.done += self.rows
        self.key, self.rows, self.tree = None, [], Appender()

    def taken(self, least: int) -> Iterator[pa.RecordBatch]:
        """What is closed, if it is ``least`` rows or more."""
        if not self.tops or len(self.tops) < least:
            return
        table = pa.Table.from_batches(self.done)
        table = table.append_column("path", _witness_array(self.before, self.after, self.levels))
        table = table.append_column("top", pa.array(self.tops, pa.binary()))
        self.done, self.before, self.after, self.levels, self.tops = [], [], [], [], []
        yield from table.combine_chunks().to_batches()


def _append_blocks(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    blocks = _Blocks(levels)
    for batch in batches:
        trees = batch.column("tree").to_pylist()
        numbers = (batch.column("place").to_numpy() // RUN**levels).tolist()
        sizes = batch.column("size").to_numpy()
        start = 0
        for i in range(1, batch.num_rows + 1):
            if i == batch.num_rows or numbers[i] != numbers[start] or trees[i] != trees[start]:
                key = (trees[start], numbers[start])
                blocks.add(key, int(sizes[start]), batch.slice(start, i - start))
                yield from blocks.taken(_NODES_AT_ONCE)
                start = i
    blocks.close()
    yield from blocks.taken(1)


def _placed(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``place``, their number in the order of their tree, and ``size``, the nodes of
    the tree; and how many rows there are at least.

    Equal rows are told apart by a number of their own, so that a partition is never larger for them.
    """
    numbered, n = write_counted(rows.withColumn("own", F.monotonically_increasing_id()), "leaves")
    parts = max(shuffle_partitions(rows.sparkSession), -(-n // NODES_PER_TASK))
    parts = max(1, min(parts, n))
    keys = ["tree", *order, "own"]
    ordered = numbered.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    ordered = write_scratch(
        ordered.withColumn("at", F.monotonically_increasing_id()).drop("own"), "ordered"
    )
    part = F.shiftright("at", 33).alias("part")  # the task, by the definition of that number
    ordered = ordered.select("*", part)
    counts = ordered.groupBy("part", "tree").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first")
    )
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "part",
        "tree",
        "first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_part"),
        F.sum("n").over(whole).alias("size"),
    )
    placed = ordered.join(offsets, ["part", "tree"])
    place = (F.col("before_part") + F.col("at") - F.col("first")).alias("place")
    return placed.select(*rows.columns, place, "size"), parts


def _rounds(nodes: DataFrame, parts: int, levels: int) -> DataFrame:
    """``nodes`` (``tree``, ``place``, ``size``, ``node`` and others) with ``path``, the whole
    witness up to the root of the tree, and ``top``, that root."""
    in_block = RUN**levels
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    block = F.floor(F.col("place") / in_block).cast("long")
    dealt = nodes.repartition(parts, "tree", block).sortWithinPartitions("tree", "place")
    appended = dealt.mapInArrow(
        lambda batches: _append_blocks(batches, levels), f"{schema}, path {_WITNESS}, top binary"
    )
    done = write_scratch(appended, "witnesses")
    largest = done.agg(F.max("size")).first()[0] or 0
    if largest <= in_block:
        return done
    # the roots of the blocks are appended further on
    above = done.where((F.col("place") % in_block == 0) & (F.col("size") > in_block)).select(
        "tree", block.alias("place"), F.ceil(F.col("size") / in_block).cast("long").alias("size"),
        F.col("top").alias("node"),
    )
    above = _rounds(above, max(1, -(-parts // in_block)), levels).select(
        "tree", F.col("place").alias("block"), F.col("path").alias("more"), F.col("top").alias("higher")
    )
    joined = done.withColumn("block", block).join(above, ["tree", "block"], "left")
    none = F.array().cast(_WITNESS)
    return joined.select(
        *nodes.columns,
        F.concat("path", F.coalesce("more", none)).alias("path"),
        F.coalesce("higher", "top").alias("top"),
    )


def _tree(rows: DataFrame, order: list[str], levels: int) -> DataFrame:
    return _rounds(*_placed(rows, order), levels)


# --- documents


def leaf(fields: list[Column]) -> Column:
    """Hexadecimal SHA-256 of the values: ``-`` for a null one, else its bytes, a colon and itself."""

    def told(field: Column) -> Column:
        text = field.cast("string")
        size = F.octet_length(text).cast("string")
        return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(told, fields)), 256)


def _as_hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def fold(node: Column, path: Column) -> Column:
    """The root that a hexadecimal node gives with the siblings of a witness."""

    def up(below: Column, level: Column) -> Column:
        parts = (_as_hex(level["before"]), below, _as_hex(level["after"]))
        return F.sha2(F.concat(*parts), 256)

    return F.aggregate(path, node, up)


def siblings(path: Column) -> Column:
    """The siblings of a witness as hexadecimal text, from the lowest level up."""
    return F.concat_ws(
        "", F.transform(path, lambda level: _as_hex(F.concat(level["before"], level["after"])))
    )


def manifest(
    docs: DataFrame, shown: Column | None = None, block_levels: int = BLOCK_LEVELS
) -> DataFrame:
    """``doc_id``, ``lang``, ``place`` (of the leaf in its language), ``leaf``, ``subroot`` (of the
    language), ``root``, ``path`` (the witness: siblings before and after, level by level),
    ``folded_root`` and ``verified`` per row.

    ``shown`` is a text to verify in place of the stored one; where it is null, or without it, the
    stored one is. ``folded_root`` is the root that the witness gives with its leaf and ``verified``
    tells whether that is the root.

    Any column may be null: a null is told from an empty text, a null language is a language of its
    own before all others, and null ids come first. Rows with one id are ordered by their leaves;
    repeated rows are leaves each. A table of one row has its leaf as root and an empty witness; an
    empty table has no rows. Columns other than the five do not count.
    """
    stored = [F.col(c) for c in FIELDS]
    other = F.lit(None).cast("string") if shown is None else shown
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(leaf(stored)).alias("node"),
        F.when(other.isNotNull(), F.unhex(leaf([*stored[:-1], other]))).alias("shown"),
    )
    # both "-" and "=" come before no other first character, and "-" before "="
    leaves = _tree(rows, ["doc_id", "node"], block_levels)
    first = leaves.where("place = 0")
    subroots = first.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("top").alias("node"))
    above = _tree(subroots, ["key"], block_levels).select(
        F.col("key").alias("tree"), F.col("path").alias("more"), F.col("top").alias("root")
    )
    path = F.concat("path", "more")
    found = leaves.join(above, "tree").select(
        "doc_id",
        F.when(F.col("tree") != "-", F.substr("tree", F.lit(2))).alias("lang"),
        "place",
        _as_hex(F.col("node")).alias("leaf"),
        _as_hex(F.col("top")).alias("subroot"),
        _as_hex(F.col("root")).alias("root"),
        path.alias("path"),
        fold(_as_hex(F.coalesce("shown", "node")), path).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
