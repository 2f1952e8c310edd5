"""Suffix-array dedup of repeated byte strings.

Which strings of ``length`` bytes stand more than once is read off the common prefixes of a suffix
order. One order of the whole corpus would be one huge sequential job, so the corpus is cut into
collections that can be ordered by themselves: every window of ``length`` bytes has an anchor, the
leftmost of its ``ANCHOR``-byte strings with the least hash, and equal windows have equal anchors at
equal offsets. The windows of one anchor occurrence form a segment. Segments with the same anchor go
to the same collection; anchors that a merged count-min sketch sees once are out at the start.

In a collection the segments are the documents of the column-wise construction (see
``collection_index``). All windows of an anchor are aligned with it, so a segment is read as symbols
of eight bytes, once for each of the eight alignments, which makes an eighth of the rounds.

Equal segments count as one with a weight, within a block before anything is sent. An anchor that
the sketch sees ``HOT`` times or more, such as the rim of a passage in a third of all documents, would
make one large collection; its windows are dealt out one by one, by 96 bits of their hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, types as T

from skyledger.llm.blocks import (
    CACHED_BYTES,
    RangeHash,
    Sketch,
    TextBlock,
    blocks_of,
    by_slice,
    byte_values,
    pack,
    per_slice,
    unpack,
)
from skyledger.llm.collection_index import suffix_order

LENGTH = 200
ANCHOR = 128
SYMBOL = 8
HOT = 2048
#: Bytes of segments that are ordered together.
COLLECTION_BYTES = 1 << 18

_LOW = np.uint64(2**32 - 1)


class Segments:
    """Runs of windows with one anchor: first window, number of windows, anchor and its hash."""

    def __init__(self, block: TextBlock, length: int, anchor: int):
        n = max(len(block.data) - length + 1, 0)
        inside = np.zeros(n + 1, np.int8)
        fits = block.lengths >= length
        inside[block.starts[fits]] += 1
        inside[(block.starts + block.lengths - length + 1)[fits]] -= 1
        inside = np.cumsum(inside[:n], dtype=np.int8).astype(bool)
        parts = [_runs_of_anchors(np.zeros(0, np.int64), np.zeros(0, np.uint64), 0)]
        for low in range(0, n, CACHED_BYTES):
            high = min(low + CACHED_BYTES, n)
            window = np.flatnonzero(inside[low:high])
            if not len(window):
                continue
            values = byte_values(block.data[low : high + length - 1], 0)
            hashes = RangeHash(values, 0).rolling(anchor)
            at = _leftmost_least(hashes, length - anchor + 1)[window]
            runs = _runs_of_anchors(window, at, low)
            parts.append((*runs[:3], hashes[runs[2] - low]))
        first, windows, at, key = (np.concatenate(x) for x in zip(*parts, strict=True))
        # a run may go on in the next piece
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1] + windows[:-1]) | (at[1:] != at[:-1])
        start = np.flatnonzero(new)
        self.first, self.at, self.key = first[start], at[start], key[start]
        self.windows = np.add.reduceat(windows, start) if len(start) else windows


def _leftmost_least(hashes: np.ndarray, reach: int) -> np.ndarray:
    """For each run of ``reach`` hashes where its least one is, by the upper half of their bits."""
    least = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
    return (least & _LOW).astype(np.int64)


def _runs_of_anchors(
    window: np.ndarray, at: np.ndarray, low: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor of each run of neighbouring windows with one
    anchor; places count from ``low``. The last array is empty, for the hashes."""
    new = np.ones(len(window), bool)
    new[1:] = (np.diff(window) != 1) | (at[1:] != at[:-1])
    start = np.flatnonzero(new)
    windows = np.diff(np.append(start, len(window)))
    anchors = at[start].astype(np.int64) + low
    return window[start] + low, windows, anchors, np.zeros(0, np.uint64)


def content_hashes(
    raw: bytes, starts: np.ndarray, stops: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each range, as two arrays."""
    ranges = zip(starts.tolist(), stops.tolist(), strict=True)
    digests = b"".join(xxhash.xxh3_128_digest(raw[a:b]) for a, b in ranges)
    pairs = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def repeated_windows(
    contents: list[bytes], offsets: list[int], weights: list[int], length: int = LENGTH
) -> list[np.ndarray]:
    """For each segment, which of its windows stand more than once in the collection.

    ``offsets`` tell where the anchor lies; windows are equal only at equal places of the anchor.
    """
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    base = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(contents) + bytes(SYMBOL), np.uint8)
    wide = np.ndarray((len(data) - SYMBOL + 1,), "<u8", data, strides=(1,))
    segment = np.repeat(np.arange(len(contents)), SYMBOL)
    shift = np.tile(np.arange(SYMBOL), len(contents))
    skip = (np.array(offsets)[segment] - shift) % SYMBOL
    n_windows = (sizes[segment] - length - skip) // SYMBOL + 1
    some = n_windows > 0
    segment, skip, n_windows = segment[some], skip[some], n_windows[some]
    span = length // SYMBOL
    lengths = n_windows + span - 1
    starts = np.cumsum(lengths) - lengths
    step = np.arange(lengths.sum()) - np.repeat(starts, lengths)
    at = np.repeat(base[segment] + skip, lengths) + SYMBOL * step
    symbols = np.unique(wide[at], return_inverse=True)[1].ravel() + 1

    owner, size, common = suffix_order(symbols, starts, lengths, span)
    classes = np.cumsum(common < span)
    whole = size >= span
    owner, size, classes = owner[whole], size[whole], classes[whole]
    weight = np.bincount(classes, np.array(weights)[segment[owner]])
    often = weight[classes] >= 2
    # a suffix of a document with ``size`` symbols is the window ``lengths - size`` symbols into it
    window = skip[owner] + SYMBOL * (lengths[owner] - size)
    per_segment = sizes - length + 1
    flat_start = np.cumsum(per_segment) - per_segment
    flat = np.zeros(int(per_segment.sum()), bool)
    flat[flat_start[segment[owner]] + window] = often
    return np.split(flat, np.cumsum(per_segment)[:-1])


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2] - edges[::2]


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    as_text: bool = False,
    carry: tuple[str, ...] = (),
    hot: int = HOT,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``: the bytes left.

    A byte goes if any string of ``length`` bytes that covers it also starts anywhere else, in the
    same document included. ``kept`` is binary, as a cut may fall inside a character; ``as_text``
    makes it text without the characters that were cut. A null text counts as empty; texts shorter
    than ``length`` stay whole; repeated rows are repeats of each other; an empty table stays empty.
    Columns to ``carry`` come back as the struct ``carried``.
    """
    if length % SYMBOL or length <= ANCHOR:
        raise ValueError(f"length must be a multiple of {SYMBOL} above {ANCHOR}")
    blocks = blocks_of(docs, carry)
    sketch = Sketch.for_keys(2 * blocks.total_bytes // (length - ANCHOR + 2))
    n_slices = blocks.n_slices

    def keys_of(block: TextBlock) -> np.ndarray:
        return Segments(block, length, ANCHOR).key

    def route(keys: np.ndarray) -> np.ndarray:
        return ((keys >> np.uint64(32)) % np.uint64(n_slices)).astype(np.int64)

    empty = {k: [b""] for k in ("key", "second", "offset", "windows", "weight", "at", "bytes")}

    def repeated(block: TextBlock, number: int, answers: pa.Table) -> Iterator[dict]:
        found = Segments(block, length, ANCHOR)
        keys, inverse = np.unique(found.key, return_inverse=True)
        estimate = sketch.estimates(keys, answers)[inverse]
        often = np.flatnonzero(estimate >= 2)
        first, windows, estimate = found.first[often], found.windows[often], estimate[often]
        key, offset = found.key[often], found.at[often] - found.first[often]
        raw = block.data.tobytes()
        one, two = content_hashes(raw, first, first + windows + length - 1)
        order = np.lexsort((first, two, one, key))
        new = np.ones(len(order), bool)
        new[1:] = np.any([np.diff(x[order]) != 0 for x in (key, one, two)], axis=0)
        group = np.cumsum(new) - 1
        count = np.bincount(group, minlength=1)
        local = order[count[group] >= 2]
        runs = [(first[local], windows[local])]
        lead = order[new]
        weight = np.minimum(count, 2).astype(np.uint8) if len(lead) else np.zeros(0, np.uint8)

        is_hot = estimate[lead] >= hot
        if is_hot.any():
            chosen = lead[is_hot]
            n = windows[chosen]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(first[chosen], n) + step
            heavy = np.repeat(weight[is_hot], n)
            one, two = content_hashes(raw, at, at + length)
            two = (two >> np.uint64(32)).astype(np.uint32)
            order = np.lexsort((two, one))
            one, two, at, heavy = one[order], two[order], at[order], heavy[order]
            start = np.flatnonzero(
                np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
            )
            total = np.add.reduceat(heavy.astype(np.int64), start)
            settled = np.repeat(total >= 2, np.diff(np.append(start, len(one))))
            runs.append((at[settled], np.ones(settled.sum(), np.int64)))
            one, two, at = one[start], two[start], at[start]
            heavy = np.minimum(total, 2).astype(np.uint8)
            to = route(one)
            order = np.argsort(to, kind="stable")
            columns = {"key": one, "second": two, "weight": heavy, "at": at.astype(np.uint32)}
            for i, part in by_slice(to[order], n_slices, {k: v[order] for k, v in columns.items()}):
                packed = {k: [pack(v)] for k, v in part.items()}
                yield empty | {"slice": [i], "block": [number]} | packed

        lead, weight = lead[~is_hot], weight[~is_hot]
        to = route(key[lead])
        order = np.argsort(to, kind="stable")
        columns = {
            "key": key[lead], "offset": offset[lead].astype(np.uint16),
            "windows": windows[lead].astype(np.uint16), "weight": weight,
            "at": first[lead].astype(np.uint32),
        }
        for i, part in by_slice(to[order], n_slices, {k: v[order] for k, v in columns.items()}):
            stops = part["at"].astype(np.int64) + part["windows"] + length - 1
            texts = [raw[a:b] for a, b in zip(part["at"].tolist(), stops.tolist(), strict=True)]
            packed = {k: [pack(v)] for k, v in part.items()} | {"bytes": [b"".join(texts)]}
            yield empty | {"slice": [i], "block": [number]} | packed

        at, n = (np.concatenate(x) for x in zip(*runs, strict=True))
        if len(at):
            packed = {"at": [pack(at.astype(np.uint32))], "windows": [pack(n.astype(np.uint32))]}
            yield empty | {"slice": [number % n_slices], "block": [number]} | packed

    def across(_: int, rows: dict[str, list]) -> Iterator[dict]:
        kinds = {"settled": [], "window": [], "segment": []}
        for i, (key, content) in enumerate(zip(rows["key"], rows["bytes"], strict=True)):
            kinds["settled" if not key else "segment" if content else "window"].append(i)
        for i in kinds["settled"]:
            yield {"block": [rows["block"][i]], "at": [rows["at"][i]], "n": [rows["windows"][i]]}
        types = {"key": np.uint64, "weight": np.uint8, "at": np.uint32}
        if chosen := kinds["window"]:
            columns = types | {"second": np.uint32}
            parts = {k: [unpack(rows[k][i], t) for i in chosen] for k, t in columns.items()}
            of = np.repeat([rows["block"][i] for i in chosen], [len(x) for x in parts["at"]])
            key, weight, at, second = (np.concatenate(parts[k]) for k in columns)
            order = np.lexsort((second, key))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(key[order]) != 0) | (np.diff(second[order]) != 0)
            group = np.cumsum(new) - 1
            total = np.bincount(group, weight[order])[group]
            yield from _by_block(order[(total >= 2) & (weight[order] == 1)], of, at, None)
        if chosen := kinds["segment"]:
            columns = types | {"offset": np.uint16, "windows": np.uint16}
            parts = {k: [unpack(rows[k][i], t) for i in chosen] for k, t in columns.items()}
            of = np.repeat([rows["block"][i] for i in chosen], [len(x) for x in parts["at"]])
            columns = {k: np.concatenate(v) for k, v in parts.items()}
            content = b"".join(rows["bytes"][i] for i in chosen)
            yield from _segments_across(of, columns, content, length)

    def strip(block: TextBlock, _: int, answers: pa.Table) -> Iterator[dict]:
        change = np.zeros(len(block.data) + 1, np.int32)
        for at, n in zip(*(answers.column(c).to_pylist() for c in ("at", "n")), strict=True):
            at, n = unpack(at, np.uint32).astype(np.int64), unpack(n, np.uint32)
            np.add.at(change, at, 1)
            np.add.at(change, at + n + length - 1, -1)
        removed = np.cumsum(change[:-1], dtype=np.int32) > 0
        begins = removed.copy()
        begins[1:] &= ~removed[:-1]
        left = block.data[~removed].tobytes()
        kept = np.append(np.int32(0), np.cumsum(~removed, dtype=np.int32))
        ends = kept[block.starts + block.lengths + 1].tolist()
        texts = [left[a:b][:-1] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        stops = block.starts + block.lengths

        def per_document(mask: np.ndarray) -> np.ndarray:
            total = np.append(np.int32(0), np.cumsum(mask, dtype=np.int32))
            return total[stops] - total[block.starts]

        yield {
            "doc_id": block.doc_ids,
            "n_bytes": block.lengths,
            "n_removed": per_document(removed),
            "n_spans": per_document(begins),
            "kept": [t.decode("utf-8", "ignore") for t in texts] if as_text else texts,
            "carried": block.carried,
        }

    sent = blocks.with_answers(
        sketch.merge(blocks, keys_of),
        repeated,
        "slice long, block long, key binary, second binary, offset binary, windows binary,"
        " weight binary, at binary, bytes binary",
    )
    settled = per_slice(sent, blocks.n_slices, across, "block long, at binary, n binary")
    result = T.StructType.fromDDL(
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept "
        + ("string" if as_text else "binary")
    )
    return blocks.with_answers(settled, strip, result.add(blocks.frame.schema["carried"]))


def _by_block(
    chosen: np.ndarray, of: np.ndarray, at: np.ndarray, n: np.ndarray | None
) -> Iterator[dict]:
    """Rows with packed runs for each block; ``n`` None: runs of one window."""
    chosen = chosen[np.lexsort((at[chosen], of[chosen]))]
    for part in np.split(chosen, np.flatnonzero(np.diff(of[chosen])) + 1):
        if len(part):
            sizes = np.ones(len(part), np.uint32) if n is None else n[part].astype(np.uint32)
            yield {
                "block": [int(of[part[0]])],
                "at": [pack(at[part].astype(np.uint32))],
                "n": [pack(sizes)],
            }


def _segments_across(
    of: np.ndarray, columns: dict[str, np.ndarray], content: bytes, length: int
) -> Iterator[dict]:
    """Runs of repeated windows out of the segments of a slice, by block."""
    sizes = columns["windows"].astype(np.int64) + length - 1
    stops = np.cumsum(sizes)
    bounds = zip((stops - sizes).tolist(), stops.tolist(), strict=True)
    number: dict[tuple[int, bytes], int] = {}
    keys = columns["key"].tolist()
    same = np.fromiter(
        (number.setdefault((k, content[a:b]), len(number)) for k, (a, b) in zip(keys, bounds)),
        np.int64,
        len(keys),
    )
    weight = np.bincount(same, columns["weight"]).astype(np.int64)
    example = np.zeros(len(number), np.int64)
    example[same[::-1]] = np.arange(len(same))[::-1]
    distinct = list(number)
    by_key = np.argsort(columns["key"][example], kind="stable")
    group_keys = columns["key"][example][by_key]
    groups = np.split(by_key, np.flatnonzero(np.diff(group_keys)) + 1)
    masks: dict[int, np.ndarray] = {}
    waiting: list[int] = []
    size = 0

    def order() -> None:
        texts = [distinct[i][1] for i in waiting]
        offsets = columns["offset"][example[waiting]].tolist()
        found = repeated_windows(texts, offsets, weight[waiting].tolist(), length)
        masks.update(zip(waiting, found, strict=True))
        waiting.clear()

    for group in groups:
        if len(group) == 1:  # one text for the anchor: its weight tells, no order is needed
            continue
        waiting.extend(group.tolist())
        size += sum(len(distinct[i][1]) for i in group)
        if size >= COLLECTION_BYTES:
            order()
            size = 0
    if waiting:
        order()
    open_ = np.flatnonzero(columns["weight"] == 1)  # others are settled in their block
    runs_of = {i: _runs(m) for i, m in masks.items()}
    plain = open_[[same[i] not in masks for i in open_]]
    plain = plain[weight[same[plain]] >= 2]
    yield from _by_block(plain, of, columns["at"], columns["windows"])
    ordered = [i for i in open_.tolist() if same[i] in masks]
    if ordered:
        counts = [len(runs_of[same[i]][0]) for i in ordered]
        at = np.concatenate([columns["at"][i] + runs_of[same[i]][0] for i in ordered])
        n = np.concatenate([runs_of[same[i]][1] for i in ordered])
        yield from _by_block(np.arange(len(at)), np.repeat(of[ordered], counts), at, n)
