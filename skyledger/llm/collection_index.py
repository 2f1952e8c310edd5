"""Suffix order and common prefixes of a collection, built column by column.

Every round takes the next symbol, from the right, of each document that still has one and inserts
the suffix that it begins. Its place follows from the place of the suffix without that symbol: among
suffixes with one first symbol the order is that of their rests. The pairs (first symbol, place of
the rest) in order are the collection's Burrows-Wheeler mapping, kept ascending, so the number of
equal symbols before a place is one binary search, and a round is one sequential merge of the new
suffixes into the arrays. The common prefix of neighbours is one more than the least common prefix
between the places of their rests, which is known from the round before.
"""

from __future__ import annotations

import numpy as np

_PLACE = np.uint64(2**32 - 1)
_SHIFT = np.uint64(32)


class _RangeMinimum:
    def __init__(self, values: np.ndarray):
        levels = [values]
        width = 1
        while 2 * width <= len(values):
            levels.append(np.minimum(levels[-1][:-width], levels[-1][width:]))
            width *= 2
        self.table = np.zeros((len(levels), len(values)), values.dtype)
        for row, level in zip(self.table, levels, strict=True):
            row[: len(level)] = level

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least value from ``low`` to ``high``, both inside."""
        level = np.log2(high - low + 1).astype(np.int64)
        return np.minimum(self.table[level, low], self.table[level, high - (1 << level) + 1])


def suffix_order(
    symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, cap: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, length and common prefix with the one before (up to ``cap``) of every suffix of the
    collection, in ascending order; the empty suffixes come first.

    ``symbols`` are integers from 1 on; document ``d`` is ``symbols[starts[d]:][:lengths[d]]``.
    """
    n_docs = len(starts)
    keys = np.arange(n_docs, dtype=np.uint64)
    common = np.zeros(n_docs, np.uint8)
    owner = np.arange(n_docs, dtype=np.int32)
    size = np.zeros(n_docs, np.int32)
    place = np.arange(n_docs)
    for column in range(1, int(lengths.max(initial=0)) + 1):
        active = np.flatnonzero(lengths >= column)
        first = symbols[starts[active] + lengths[active] - column].astype(np.uint64)
        new = (first << _SHIFT) | place[active].astype(np.uint64)
        order = np.argsort(new)
        active, new = active[order], new[order]
        at = np.searchsorted(keys, new)

        rests = _RangeMinimum(common)

        def prefix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            same = left >> _SHIFT == right >> _SHIFT
            low = (left & _PLACE).astype(np.int64) + 1
            high = (right & _PLACE).astype(np.int64)
            low, high = np.where(same, low, 0), np.where(same, high, 0)
            least = np.minimum(rests.of(low, high).astype(np.int64) + 1, cap)
            return np.where(same, least, 0).astype(np.uint8)

        left = keys[at - 1]  # the empty suffixes come before all others
        behind_new = np.flatnonzero(at[1:] == at[:-1]) + 1
        left[behind_new] = new[behind_new - 1]
        new_common = prefix(left, new)
        last = np.ones(len(at), bool)
        last[behind_new - 1] = False
        last &= at < len(keys)
        common = common.copy()
        common[at[last]] = prefix(new[last], keys[at[last]])

        new_place = at + np.arange(len(at))
        old = np.ones(len(keys) + len(new), bool)
        old[new_place] = False
        old_place = np.flatnonzero(old)

        def merged(before: np.ndarray, added: np.ndarray) -> np.ndarray:
            both = np.empty(len(old), before.dtype)  # noqa: B023
            both[old_place] = before  # noqa: B023
            both[new_place] = added  # noqa: B023
            return both

        keys = merged(keys, new)
        moved = old_place[(keys & _PLACE).astype(np.int64)].astype(np.uint64)
        keys = (keys & ~_PLACE) | moved
        common = merged(common, new_common)
        owner = merged(owner, active)
        size = merged(size, np.int32(column))
        place[active] = new_place
    return owner, size, common
