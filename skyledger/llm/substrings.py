"""Substring dedup of word windows with a count-min prefilter.

A window is ``width`` consecutive words of one document. The first pass counts window hashes in a
merged sketch; windows that it estimates to stand once are out, and since a sketch never estimates
too low, no repeated window is lost. The second pass groups the others exactly, by 96 bits of two
independent hashes of their words, and finds for each the smallest document id. Within a block this
is settled on the spot, so a block sends each window once, with its smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm.blocks import (
    RangeHash,
    Sketch,
    TextBlock,
    blocks_of,
    by_slice,
    pack,
    pack_sorted,
    per_slice,
    unpack,
    unpack_sorted,
)

WIDTH = 13
#: Bytes of text per word, for the width of the sketch; a wrong guess costs precision only.
BYTES_PER_WORD = 6


def _windows(block: TextBlock, width: int) -> np.ndarray:
    """Index of the first word of every window."""
    doc = block.words[2]
    if len(doc) < width:
        return np.zeros(0, np.int64)
    return np.flatnonzero(doc[: len(doc) - width + 1] == doc[width - 1 :])


def _window_hashes(block: TextBlock, width: int, which: int) -> np.ndarray:
    return RangeHash(block.word_hashes(which), which).rolling(width)


def _decided(first: np.ndarray, second: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of windows sorted by hashes and id: which have the same window under a smaller id."""
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    group = np.cumsum(new) - 1
    return ids > ids[np.flatnonzero(new)][group]


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_text``: the words left, joined by a space.

    A word goes if any window that covers it also starts in a document with a smaller id; windows
    are those of the input. A null text has no words. A null id counts as smaller than all others.
    Rows with equal ids remove nothing from each other. An empty table stays empty.
    """
    blocks = blocks_of(docs)
    sketch = Sketch.for_keys(blocks.total_bytes // BYTES_PER_WORD)
    n_slices = blocks.n_slices

    def keys_of(block: TextBlock) -> np.ndarray:
        return _window_hashes(block, width, 0)[_windows(block, width)]

    def repeated(block: TextBlock, number: int, answers: pa.Table) -> Iterator[dict]:
        windows = _windows(block, width)
        hashes = _window_hashes(block, width, 0)[windows]
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        estimate = sketch.estimates(ordered[new], answers)
        often = estimate[np.cumsum(new) - 1] >= 2
        word, first = windows[order[often]], ordered[often]
        second = (_window_hashes(block, width, 1)[word] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((word, second, first))
        word, first, second = word[order], first[order], second[order]
        ids = block.ids[block.words[2][word]]
        gone = _decided(first, second, ids)
        empty = [b""]
        if gone.any():
            yield {
                "slice": [number % n_slices], "block": [number], "first": empty, "second": empty,
                "id": empty, "word": [pack_sorted(np.sort(word[gone]))],
            }
        word, first, second, ids = word[~gone], first[~gone], second[~gone], ids[~gone]
        to = ((first >> np.uint64(32)) % np.uint64(n_slices)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        columns = {"first": first, "second": second, "id": ids, "word": word.astype(np.uint32)}
        parts = by_slice(to[order], n_slices, {k: v[order] for k, v in columns.items()})
        for i, part in parts:
            yield {"slice": [i], "block": [number]} | {k: [pack(v)] for k, v in part.items()}

    def across(_: int, rows: dict[str, list]) -> Iterator[dict]:
        local = [i for i, x in enumerate(rows["first"]) if not x]
        if local:
            yield {"block": [rows["block"][i] for i in local], "word": [rows["word"][i] for i in local]}
        sent = [i for i, x in enumerate(rows["first"]) if x]
        if not sent:
            return
        types = {"first": np.uint64, "second": np.uint32, "id": np.int64, "word": np.uint32}
        parts = {k: [unpack(rows[k][i], t) for i in sent] for k, t in types.items()}
        of = np.repeat([rows["block"][i] for i in sent], [len(x) for x in parts["word"]])
        first, second, ids, word = (np.concatenate(parts[k]) for k in types)
        order = np.lexsort((ids, second, first))
        gone = order[_decided(first[order], second[order], ids[order])]
        gone = gone[np.lexsort((word[gone], of[gone]))]
        cuts = np.flatnonzero(np.diff(of[gone])) + 1
        for part in np.split(gone, cuts):
            if len(part):
                yield {"block": [int(of[part[0]])], "word": [pack_sorted(word[part])]}

    def strip(block: TextBlock, _: int, answers: pa.Table) -> Iterator[dict]:
        starts, stops, doc = block.words
        change = np.zeros(len(starts) + width + 1, np.int64)
        for blob in answers.column("word").to_pylist():
            at = unpack_sorted(blob)
            change[at] += 1
            change[at + width] -= 1
        removed = np.cumsum(change)[: len(starts)] > 0
        # a kept word takes the byte behind it along, which becomes a space
        mark = np.zeros(len(block.data) + 1, np.int8)
        mark[starts[~removed]] += 1
        mark[stops[~removed] + 1] -= 1
        kept = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
        spaced = block.data.copy()
        spaced[stops] = 0x20
        left = spaced[kept].tobytes()
        ends = np.concatenate([[0], np.cumsum(kept)])[block.starts + block.lengths + 1].tolist()
        texts = [left[a:b][:-1] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        yield {
            "doc_id": block.doc_ids,
            "n_words": np.bincount(doc, minlength=len(block)),
            "n_removed": np.bincount(doc[removed], minlength=len(block)),
            "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
        }

    sent = blocks.with_answers(
        sketch.merge(blocks, keys_of),
        repeated,
        "slice long, block long, first binary, second binary, id binary, word binary",
    )
    found = per_slice(sent, blocks.n_slices, across, "block long, word binary")
    return blocks.with_answers(
        found, strip, "doc_id long, n_words long, n_removed long, kept_text string"
    )
