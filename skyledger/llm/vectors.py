"""Near-duplicate vectors by small-world graphs, one per shard.

Equal vectors count as one with a number of copies. The others are dealt to shards by a hash; each
shard builds its graph and answers the queries of all vectors. Before that, an audit compares what
the graph finds with plain products and widens the beam until enough links are found: those of a
sample of the queries of all shards, and planted ones, from vectors of the shard moved aside to
cosines from the threshold up. A shard whose widest beam fails answers by plain products. Cosines
of what is proposed are computed in double precision, and links below the threshold are dropped.

A shard returns link counts and, for the components, a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skyledger.llm.common import write_scratch
from skyledger.llm.components import components
from skyledger.llm.hnsw import Graph

SHARDS = 12
#: Beyond SHARDS times this many bytes of vectors there are more shards, each of about this size.
SHARD_BYTES = 64 << 20
#: Bytes of a component in a shard, in single and in double precision.
COMPONENT_BYTES = 12
FIRST_BEAM = 24
#: Beyond this beam plain products answer.
WIDEST_BEAM = 384
#: Queries of all shards, drawn by a hash of the id per length of vectors, and own vectors of a shard that
#: an audit asks for.
AUDITED = 512
AUDITED_AT_ONCE = 64
RECALL = 0.98
QUERIES_AT_ONCE = 2048
#: Vectors of a shard in one block of plain products.
EXACT_AT_ONCE = 4096
#: What a row of a shard is, in the order in which it comes.
_OWN, _AUDIT, _QUERY = range(3)
#: Single precision may be off by less than this.
_SLACK = 1e-5


class _Forest:
    """Keeps of the links it is shown those that join two trees."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def joins(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


class Shard:
    """Unit vectors (double) with their ids and copies, and a graph over them. ``asked`` are the
    ids and vectors of the queries to audit with; without them some of its own are."""

    def __init__(
        self,
        ids: np.ndarray,
        copies: np.ndarray,
        vectors: np.ndarray,
        least: float,
        asked: tuple[np.ndarray, np.ndarray] | None = None,
    ):
        self.ids, self.copies, self.vectors, self.least = ids, copies, vectors, least
        self.single = vectors.astype(np.float32)
        self.graph = Graph(self.single)
        self.beam = min(FIRST_BEAM, len(ids))
        self.exact = False
        own = np.arange(0, len(ids), max(1, -(-len(ids) // AUDITED)))
        self.recall = self._audited(own, *(asked or (ids[own], vectors[own])))

    def _audited(self, own: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> float:
        """Widens the beam until both recalls pass; where none is wide enough, plain products
        answer."""
        queries = vectors.astype(np.float32)
        linked = [np.zeros(0, np.int64)]
        for start in range(0, len(ids), AUDITED_AT_ONCE):
            rows = slice(start, start + AUDITED_AT_ONCE)
            cosine = queries[rows] @ self.single.T
            cosine[ids[rows, None] == self.ids] = -2  # itself
            linked.append(np.flatnonzero(cosine >= self.least) + start * len(self.ids))
        linked = np.concatenate(linked)
        planted = self._planted(own)
        while True:
            found = self._recall(linked, *self.graph.within(queries, self.least, self.beam))
            row, node = self.graph.within(planted, self.least - _SLACK, self.beam)
            found = min(found, float((own[row] == node).sum()) / len(own))
            if found >= RECALL:
                return found
            if self.beam >= min(WIDEST_BEAM, len(self.ids)):
                self.exact = True
                return 1.0
            self.beam = min(2 * self.beam, WIDEST_BEAM, len(self.ids))

    def _planted(self, own: np.ndarray) -> np.ndarray:
        """Vectors beside own ones, at cosines from ``least`` up to a quarter of what lacks to one (in
        one dimension, where there are no such, multiples of the own)."""
        vectors = self.vectors[own]
        aside = np.random.default_rng(11).normal(size=vectors.shape)
        aside -= np.einsum("ij,ij->i", aside, vectors)[:, None] * vectors
        length = np.sqrt(np.einsum("ij,ij->i", aside, aside))[:, None]
        aside = np.divide(aside, length, out=np.zeros_like(aside), where=length > 1e-9)
        least = max(self.least, -1.0)
        cosine = np.linspace(min(1.0, least), min(1.0, (1 + 3 * least) / 4), len(own))[:, None]
        moved = np.where(cosine != 0, cosine * vectors + np.sqrt(1 - cosine**2) * aside, vectors)
        return _unit(np.where(length > 1e-9, moved, vectors)).astype(np.float32)

    def _recall(self, true: np.ndarray, row: np.ndarray, node: np.ndarray) -> float:
        """Share of the true pairs, numbered through, that were found."""
        return float(np.isin(true, row * len(self.ids) + node).mean()) if len(true) else 1.0

    def _proposed(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of the query, node) that may be links."""
        least = self.least - _SLACK
        if not self.exact:
            return self.graph.within(queries, least, self.beam)
        rows, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start in range(0, len(self.single), EXACT_AT_ONCE):
            row, node = np.nonzero(queries @ self.single[start : start + EXACT_AT_ONCE].T >= least)
            rows.append(row)
            nodes.append(node + start)
        return np.concatenate(rows), np.concatenate(nodes)

    def links(self, ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of the query, node) of different ids with a cosine of ``least`` or more."""
        row, node = self._proposed(vectors.astype(np.float32))
        other = ids[row] != self.ids[node]
        row, node = row[other], node[other]
        cosine = np.einsum("ij,ij->i", vectors[row], self.vectors[node])
        return row[cosine >= self.least], node[cosine >= self.least]


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: not null, without null or non-finite parts, not zero."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)),
    )
    nonzero = F.exists(vector, lambda x: x != 0)
    return F.coalesce(finite & nonzero, F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no square overflows
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return _unit(flat.reshape(batch.num_rows, -1))


def _shard_links(work: DataFrame, least: float) -> DataFrame:
    """``node``, ``links`` (of this shard) and ``other`` (a link of the forest, else null)."""
    names = ["node", "links", "other"]

    def result(nodes: list, links: list, others: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (nodes, links, others)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard = None, None
        own: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        asked: list[tuple[np.ndarray, np.ndarray]] = []
        forest = _Forest()
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = batch.column("dim").to_numpy()
            shards, kinds = batch.column("shard").to_numpy(), batch.column("query").to_numpy()
            change = np.flatnonzero(
                (np.diff(dims) != 0) | (np.diff(shards) != 0) | (np.diff(kinds) != 0)
            )
            cuts = [0, *(change + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(a, b - a)
                if key != (dims[a], shards[a]):
                    key, shard, forest = (dims[a], shards[a]), None, _Forest()
                    own, asked = [], []
                ids, copies = part.column("rep").to_numpy(), part.column("copies").to_numpy()
                if kinds[a] == _OWN:
                    own.append((ids, copies, _matrix(part)))
                    continue
                if kinds[a] == _AUDIT:
                    asked.append((ids, _matrix(part)))
                    continue
                if shard is None and own:
                    parts = (np.concatenate(x) for x in zip(*own, strict=True))
                    sample = tuple(np.concatenate(x) for x in zip(*asked, strict=True))
                    shard = Shard(*parts, least, sample or None)
                    own, asked = [], []
                if shard is None:
                    continue
                vectors = _matrix(part)
                for i in range(0, len(ids), QUERIES_AT_ONCE):
                    some = ids[i : i + QUERIES_AT_ONCE]
                    row, node = shard.links(some, vectors[i : i + QUERIES_AT_ONCE])
                    count = np.bincount(row, shard.copies[node], len(some)).astype(np.int64)
                    has = np.flatnonzero(count)
                    yield result(some[has].tolist(), count[has].tolist(), [None] * len(has))
                    pairs = zip(some[row].tolist(), shard.ids[node].tolist(), strict=True)
                    kept = [p for p in pairs if forest.joins(*p)]
                    if kept:
                        nodes, others = map(list, zip(*kept, strict=True))
                        yield result(nodes, [0] * len(kept), others)

    return work.mapInArrow(run, "node long, links long, other long")


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.9,
    n_shards: int = SHARDS,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` per row of ``vectors``.

    A link joins two rows with a cosine of ``least`` or more. ``component_id`` is the smallest id
    reachable by links and a row is kept if that is its own. Vectors that are null, zero, or hold a
    null or non-finite part link with nothing, as do vectors of different lengths. A null id links
    with nothing, has a null component and is not kept. Equal rows are links of each other. An
    empty table stays empty.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
    good = F.col("vec_id").isNotNull() & usable(F.col("vector"))
    keyed = rows.select(
        "vec_id",
        "vector",
        F.when(good, F.xxhash64("vector")).alias("key_one"),
        F.when(good, F.xxhash64(F.lit(1), "vector")).alias("key_two"),
    )
    keys = ["key_one", "key_two"]
    reps = write_scratch(
        keyed.where(F.col("key_one").isNotNull())
        .groupBy(*keys)
        .agg(
            F.min("vec_id").alias("rep"),
            F.count("*").alias("copies"),
            F.first("vector").alias("vector"),
        )
        .withColumn("dim", F.size("vector")),
        "vectors",
    )
    size = COMPONENT_BYTES * (reps.agg(F.sum("dim")).first()[0] or 0)
    n_shards = max(n_shards, -(-size // SHARD_BYTES))
    columns = ["dim", "shard", "query", "rep", "copies", "vector"]
    own = reps.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(n_shards)).cast("int"))
    own = own.withColumn("query", F.lit(_OWN)).select(columns)
    sizes = F.broadcast(reps.groupBy("dim").agg(F.count("*").alias("size")))
    audited = reps.join(sizes, "dim").where(
        F.pmod(F.xxhash64(F.lit("audit"), "rep"), F.col("size")) < AUDITED
    )
    everywhere = F.explode(F.array(*map(F.lit, range(n_shards))))
    audited = audited.withColumn("shard", everywhere).withColumn("query", F.lit(_AUDIT))
    asked = reps.withColumn("shard", everywhere).withColumn("query", F.lit(_QUERY))
    work = (
        own.unionByName(audited.select(columns))
        .unionByName(asked.select(columns))
        .repartitionByRange(n_shards, "dim", "shard")
        .sortWithinPartitions("dim", "shard", "query", "rep")
    )
    found = write_scratch(_shard_links(work, least), "links")
    counts = found.groupBy(F.col("node").alias("rep")).agg(F.sum("links").alias("links"))
    joined = components(
        found.where(F.col("other").isNotNull()).select(F.col("node").alias("a"), F.col("other").alias("b"))
    ).select(F.col("node").alias("rep"), "component")
    of_rep = (
        reps.select(*keys, "rep", "copies").join(counts, "rep", "left").join(joined, "rep", "left")
    ).select(
        *keys,
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    )
    component = F.coalesce("component", "vec_id")
    return keyed.select("vec_id", *keys).join(of_rep, keys, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
