from __future__ import annotations

import math

import numpy as np
import pytest

import brute
from skyledger.llm.hnsw import Graph
from skyledger.llm.vectors import Shard, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def clusters(seed, n, n_clusters, dim=16, noise=0.1):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(n_clusters, dim))
    own = centres[random.integers(0, n_clusters, n)]
    return (own + noise * random.normal(size=own.shape)).astype(np.float32)


def plain(rows, least):
    """(vec_id, n_links, component_id, kept) by all products."""

    def good(i, v):
        return (
            i is not None
            and v is not None
            and all(x is not None and math.isfinite(x) for x in v)
            and any(v)
        )

    usable = [k for k, (i, v) in enumerate(rows) if good(i, v)]
    links, groups = [0] * len(rows), brute.Groups()
    for a in usable:
        x = np.array(rows[a][1], float)
        for b in usable:
            y = np.array(rows[b][1], float)
            if a != b and len(x) == len(y) and x @ y >= least * np.sqrt((x @ x) * (y @ y)):
                links[a] += 1
                groups.join(rows[a][0], rows[b][0])
    component = [None if i is None else groups.root(i) for i, _ in rows]
    return [(i, links[k], component[k], component[k] == i and i is not None) for k, (i, _) in enumerate(rows)]


def test_the_graph_finds_near_neighbours():
    vectors = clusters(1, 3000, 150)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = Graph(vectors)
    assert len(graph.layers) > 1
    row, node = graph.within(vectors[:300], 0.9, 24)
    exact = vectors[:300] @ vectors.T >= 0.9
    found = np.zeros_like(exact)
    found[row, node] = True
    assert not (found & ~exact).any()
    assert found.sum() >= 0.97 * exact.sum()


@pytest.mark.parametrize("n", [1, 2, 3, 17, 40])
def test_small_graphs_are_complete(n):
    vectors = clusters(n, n, 3)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    row, node = Graph(vectors).within(vectors, -1.0, 4)
    assert len(set(zip(row.tolist(), node.tolist()))) == n * n


def test_an_audit_widens_the_beam():
    vectors = clusters(2, 2000, 4, noise=0.05).astype(float)  # hundreds of links each
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids = np.arange(len(vectors))
    shard = Shard(ids, np.ones(len(ids), int), vectors, 0.9)
    assert shard.recall >= 0.98
    row, node = shard.links(ids, vectors)
    exact = (vectors @ vectors.T >= 0.9).sum() - len(ids)
    assert len(row) >= 0.97 * exact


def unrelated(seed, n, dim=64):
    vectors = np.random.default_rng(seed).normal(size=(n, dim))
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def beside(seed, vectors, cosine):
    aside = unrelated(seed, *vectors.shape)
    aside -= (aside * vectors).sum(1, keepdims=True) * vectors
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    return cosine * vectors + np.sqrt(1 - cosine**2) * aside


def test_an_audit_without_a_near_pair_has_planted_ones():
    """Among unrelated vectors the graph answers, and finds what stands just inside the threshold."""
    vectors = unrelated(4, 3000)
    ids = np.arange(len(vectors))
    asked = (np.arange(10_000, 10_400), unrelated(12, 400))
    shard = Shard(ids, np.ones(len(ids), int), vectors, 0.9, asked)
    assert shard.recall >= 0.98 and not shard.exact
    for cosine in (0.902, 0.91, 0.95):
        row, node = shard.links(ids + 10_000, beside(5, vectors, cosine))
        assert (row == node).sum() >= 0.98 * len(ids)


def test_a_graph_that_misses_is_not_asked():
    class Lost(Graph):
        def search(self, queries, beam):
            ids, sims = super().search(queries, beam)
            return np.where(ids % 2 == 1, -1, ids), np.where(ids % 2 == 1, -np.inf, sims)

    vectors = unrelated(6, 500)
    ids = np.arange(len(vectors))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("skyledger.llm.vectors.Graph", Lost)
        shard = Shard(ids, np.ones(len(ids), int), vectors, 0.9)
        row, node = shard.links(ids + 10_000, beside(7, vectors, 0.95))
    assert (row == node).sum() == len(ids)
    assert shard.exact


def test_sparse_links_across_shards(spark):
    vectors = unrelated(8, 1500)
    vectors = np.concatenate([vectors, beside(9, vectors[:200], 0.92)]).astype(np.float32)
    rows = [(k, v) for k, v in enumerate(vectors.tolist())]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(5)
    got = {r.vec_id: r for r in near_vectors(frame, n_shards=12).collect()}
    exact = vectors.astype(float)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    n_links = (exact @ exact.T >= 0.9).sum(axis=1) - 1
    assert n_links.sum() == 400
    assert sum(r.n_links for r in got.values()) >= 0.98 * 400
    assert all(r.n_links <= n_links[i] for i, r in got.items())


def test_links_of_clusters(spark):
    vectors = clusters(3, 600, 60)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000 + k, rows[7][1]) for k in range(200)]  # a large group of copies
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(5)
    got = near_vectors(frame, n_shards=3).collect()
    expected = plain([(i, np.float32(v).astype(float).tolist()) for i, v in rows], 0.9)
    wanted = {i: n for i, n, *_ in expected}
    assert sum(r.n_links for r in got) >= 0.99 * sum(wanted.values())
    assert all(r.n_links <= wanted[r.vec_id] for r in got)
    components = {i: c for i, _, c, _ in expected}
    assert sum(r.component_id == components[r.vec_id] for r in got) >= 0.99 * len(got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [3.0, 0.0, 0.1]),
        (None, [1.0, 0.0]), (11, [0.0, 1.0]), (11, [0.0, 1.0]), (12, [-1.0, 0.0]), (13, [-0.0, 1.0]),
        (14, [3e38, 1.0]), (15, [1e-38, 0.0]), (16, [9.0, 4.0]), (17, [0.9, 0.43588989]),
    ]
    frame = spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    for name in ("rep", "shard", "vector", "key_one", "copies", "dim", "query"):
        frame = frame.selectExpr("*", f"'x' as {name}")
    got = near_vectors(frame, n_shards=2).collect()
    singles = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert bag(got) == bag(plain(singles, 0.9))
    assert near_vectors(frame.limit(0)).count() == 0
