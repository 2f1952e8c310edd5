"""A hierarchical navigable small-world graph over unit vectors, built and searched in batches.

Many searches walk in step: each round expands the best open nodes of every beam at once, so the
work is in array operations. Nodes are inserted in batches that are never larger than the graph so
far; within a batch they see each other by a block of plain products.
"""

from __future__ import annotations

import numpy as np

NEIGHBOURS = 16
BUILD_BEAM = 48
MOST_AT_ONCE = 512
EXPANDED_AT_ONCE = 4


class Layer:
    def __init__(self, capacity: int, width: int):
        self.width = width
        self.links = np.full((capacity, width), -1, np.int32)


class Graph:
    """``vectors`` are unit vectors as rows (float32)."""

    def __init__(self, vectors: np.ndarray, neighbours: int = NEIGHBOURS, beam: int = BUILD_BEAM):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        n = len(vectors)
        self.neighbours, self.beam = neighbours, beam
        uniform = np.random.default_rng(7).random(n)
        self.level = np.floor(-np.log(1 - uniform) / np.log(neighbours)).astype(np.int64)
        self.layers: list[Layer] = []
        self.entry = 0
        done = 0
        while done < n:
            size = min(max(done, 1), MOST_AT_ONCE, n - done)
            self._insert(np.arange(done, done + size), done)
            done += size

    def _layer(self, level: int) -> Layer:
        while len(self.layers) <= level:
            width = self.neighbours * (2 if not self.layers else 1)
            self.layers.append(Layer(len(self.vectors), width))
        return self.layers[level]

    def _insert(self, nodes: np.ndarray, done: int) -> None:
        top = int(self.level[nodes].max())
        queries = self.vectors[nodes]
        batch_sims = queries @ queries.T
        np.fill_diagonal(batch_sims, -np.inf)
        old_top = len(self.layers) - 1
        self._layer(max(top, old_top))
        at = np.full((len(nodes), 1), self.entry, np.int32)
        for level in range(len(self.layers) - 1, -1, -1):
            joining = self.level[nodes] >= level
            if done and level <= old_top:
                beam = self.beam if joining.any() else 1
                ids, sims = self._search(queries, at, beam, level)
                at = ids[:, : max(1, min(4, ids.shape[1]))]
            else:
                ids = np.full((len(nodes), 1), -1, np.int32)
                sims = np.full((len(nodes), 1), -np.inf, np.float32)
            if not joining.any():
                continue
            peers = np.where(joining[None, :], batch_sims, -np.inf)[joining]
            k = min(self.beam, peers.shape[1])
            near = np.argpartition(-peers, k - 1, axis=1)[:, :k]
            peer_sims = np.take_along_axis(peers, near, axis=1)
            peer_ids = np.where(np.isfinite(peer_sims), nodes[near], -1).astype(np.int32)
            ids = np.concatenate([ids[joining], peer_ids], axis=1)
            sims = np.concatenate([sims[joining], peer_sims], axis=1)
            self._connect(nodes[joining], ids, sims, level)
        best = int(nodes[self.level[nodes].argmax()])
        if not done or top > self.level[self.entry]:
            self.entry = best

    def _choose(self, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Of the candidates of each row: those that are closer to the row's node than to any chosen
        before them, then the closest others, up to ``width``."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, : max(2 * width, self.beam)]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        some = (ids >= 0) & np.isfinite(sims)
        vectors = self.vectors[np.maximum(ids, 0)]
        between = vectors @ vectors.transpose(0, 2, 1)
        chosen = np.zeros(ids.shape, bool)
        for i in range(ids.shape[1]):
            shadowed = (chosen & (between[:, i] > sims[:, i, None])).any(axis=1)
            chosen[:, i] = some[:, i] & ~shadowed & (chosen.sum(axis=1) < width)
        rank = np.where(chosen, 0, np.where(some, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        first = np.argsort(rank, axis=1)[:, :width]
        picked = np.take_along_axis(np.where(some, ids, -1), first, 1)
        if picked.shape[1] < width:
            picked = np.pad(picked, ((0, 0), (0, width - picked.shape[1])), constant_values=-1)
        return picked

    def _connect(self, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray, level: int) -> None:
        layer = self.layers[level]
        layer.links[nodes] = self._choose(ids, sims, layer.width)
        target = layer.links[nodes].ravel()
        source = np.repeat(nodes, layer.width)
        source, target = source[target >= 0], target[target >= 0]
        if not len(target):
            return
        similar = np.einsum("ij,ij->i", self.vectors[source], self.vectors[target])
        order = np.lexsort((-similar, target))
        source, target, similar = source[order], target[order], similar[order]
        distinct, start, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(start, count)
        keep = place < 2 * layer.width
        more = np.full((len(distinct), min(int(count.max()), 2 * layer.width)), -1, np.int32)
        row = np.repeat(np.arange(len(distinct)), count)
        more[row[keep], place[keep]] = source[keep]
        old = layer.links[distinct]
        both = np.concatenate([old, more], axis=1)
        # a new node that chose its target may be among the old links already
        twice = (more[:, :, None] == old[:, None, :]).any(axis=2)
        both[:, old.shape[1] :][twice] = -1
        vectors = self.vectors[np.maximum(both, 0)]
        sims = np.einsum("ijk,ik->ij", vectors, self.vectors[distinct])
        sims = np.where(both >= 0, sims, -np.inf)
        layer.links[distinct] = self._choose(both, sims, layer.width)

    def _search(
        self, queries: np.ndarray, at: np.ndarray, beam: int, level: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best nodes of a layer that a walk from ``at`` reaches, best first."""
        n = len(queries)
        rows = np.arange(n)
        links = self.layers[level].links
        seen = np.zeros((n, len(self.vectors)), bool)
        ids = np.full((n, beam), -1, np.int32)
        sims = np.full((n, beam), -np.inf, np.float32)
        closed = np.ones((n, beam), bool)

        def offer(active: np.ndarray, new: np.ndarray) -> None:
            new = np.where(new >= 0, new, 0)
            fresh = ~seen[active[:, None], new]
            # the same node may be offered twice in a row
            order = np.argsort(new, axis=1, kind="stable")
            ordered = np.take_along_axis(new, order, 1)
            again = np.zeros(new.shape, bool)
            np.put_along_axis(again, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
            fresh &= ~again
            seen[active[:, None], new] = True
            found = np.einsum("ijk,ik->ij", self.vectors[new], queries[active])
            found = np.where(fresh, found, -np.inf).astype(np.float32)
            all_sims = np.concatenate([sims[active], found], axis=1)
            all_ids = np.concatenate([ids[active], new.astype(np.int32)], axis=1)
            all_closed = np.concatenate([closed[active], ~fresh], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            sims[active] = np.take_along_axis(all_sims, best, 1)
            ids[active] = np.take_along_axis(all_ids, best, 1)
            closed[active] = np.take_along_axis(all_closed, best, 1)

        offer(rows, at)
        active = rows
        while len(active):
            open_sims = np.where(closed[active], -np.inf, sims[active])
            k = min(EXPANDED_AT_ONCE, beam)
            pick = np.argpartition(-open_sims, k - 1, axis=1)[:, :k] if beam > k else None
            if pick is None:
                pick = np.broadcast_to(np.arange(beam), (len(active), beam))
            usable = np.isfinite(np.take_along_axis(open_sims, pick, 1))
            going = usable.any(axis=1)
            active, pick, usable = active[going], pick[going], usable[going]
            if not len(active):
                break
            closed[active[:, None], pick] = True
            nodes = np.where(usable, ids[active[:, None], pick], -1)
            new = np.where(nodes[:, :, None] >= 0, links[np.maximum(nodes, 0)], -1)
            new = new.reshape(len(active), -1)
            # an empty link stands for the node itself, which has been seen
            offer(active, np.where(new >= 0, new, nodes.max(axis=1)[:, None]))
        ids = np.where(np.isfinite(sims), ids, -1)
        return ids, sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: none) and similarities of the best nodes found for each query."""
        at = np.full((len(queries), 1), self.entry, np.int32)
        for level in range(len(self.layers) - 1, 0, -1):
            at = self._search(queries, at, 1, level)[0]
        return self._search(queries, at, min(beam, len(self.vectors)), 0)

    def within(
        self, queries: np.ndarray, least: float, beam: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) with a similarity of ``least`` or more; a beam that is full of them is
        doubled."""
        rows, nodes = [], []
        open_ = np.arange(len(queries))
        while len(open_):
            ids, sims = self.search(queries[open_], beam)
            full = (sims[:, -1] >= least) & (ids.shape[1] < len(self.vectors))
            row, column = np.nonzero((sims >= least) & (ids >= 0) & ~full[:, None])
            rows.append(open_[row])
            nodes.append(ids[row, column])
            open_ = open_[full]
            beam *= 2
        return np.concatenate(rows), np.concatenate(nodes).astype(np.int64)
