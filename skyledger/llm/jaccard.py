"""Join of documents by the Jaccard similarity of their word shingles, with adaptive prefixes.

1. A merged count-min sketch counts in how many documents each shingle stands. A document of which
   too few shingles stand elsewhere can have no partner and is done. Documents with equal sets
   count as one from here on.
2. Groups of copies: documents that share a minimum hash are compared with one of them, the one with
   the most frequent shingles. That links most of a large group by one comparison per document.
3. Shingles in ascending order of their estimated counts: documents that are similar enough share
   a shingle among the first ones (the prefix). Groups that share no prefix shingle with another
   group are done; the others fall into families.
4. Within a family every document chooses how many shingles must match: ``l`` matches in a prefix
   that is ``l - 1`` longer cost more index entries and leave fewer candidates. It takes the
   cheapest ``l`` by the lengths of the index lists, and candidates are verified exactly. Pairs that
   are connected already are not compared. A family too large for one task is cut into tiles.

What connects documents is a subset of all links that connects the same documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.blocks import NO_ID, RangeHash, Sketch, TextBlock, blocks_of
from skyledger.llm.common import map_batches, mixed, write_scratch
from skyledger.llm.components import components

WORDS = 5
PERCENT = 80
HASH_KEYS = 3
TILE = 512
LONGEST = 8
#: Cost of verifying a candidate, in index entries.
VERIFY_COST = 20
BYTES_PER_WORD = 6


def shingle_sets(block: TextBlock, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles as ascending hashes, document by document, and where each begins. A text
    with fewer words than a shingle has all its words as one."""
    hashes = block.word_hashes(0, lower=True)
    doc = block.words[2]
    n_words = np.bincount(doc, minlength=len(block))
    first = np.cumsum(n_words) - n_words
    ranges = RangeHash(hashes, 1)
    n = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
    of = np.repeat(np.arange(len(block)), n)
    start = first[of] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    stop = np.minimum(start + words, (first + n_words)[of])
    shingles = ranges.of(start, stop)
    order = np.lexsort((shingles, of))
    shingles, of = shingles[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (of[1:] != of[:-1])
    shingles, of = shingles[new], of[new]
    return shingles, np.searchsorted(of, np.arange(len(block) + 1))


def needed(size, percent: int):
    """Least overlap of a set of this size with any partner."""
    return -(-size * percent // 100)


_SETS = (
    "doc_id long, n_shingles long, candidate boolean, set_one long, set_two long,"
    " popularity double, keys binary, shingles binary, counts binary"
)


def document_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """A row per row of ``docs``. Candidates carry a 128-bit digest of their set; the first with a
    digest in its block carries the set in prefix order and the estimated counts too."""
    blocks = blocks_of(docs)
    sketch = Sketch.for_keys(blocks.total_bytes // BYTES_PER_WORD)

    def describe(block: TextBlock, _: int, answers: pa.Table) -> Iterator[dict]:
        shingles, bounds = shingle_sets(block, words)
        distinct, inverse = np.unique(shingles, return_inverse=True)
        count = sketch.estimates(distinct, answers)[inverse]
        sizes = np.diff(bounds)
        total = np.concatenate([[0], np.cumsum(count >= 2)])
        often = total[bounds[1:]] - total[bounds[:-1]]
        named = block.ids != NO_ID
        candidate = (sizes > 0) & (100 * often >= percent * sizes) & named
        n = len(block)
        digest = np.zeros((2, n), np.int64)
        popularity = np.zeros(n)
        blobs: dict[str, list] = {k: [None] * n for k in ("keys", "shingles", "counts")}
        seen: set[tuple[int, int]] = set()
        for i in np.flatnonzero(candidate).tolist():
            own, often_i = shingles[bounds[i] : bounds[i + 1]], count[bounds[i] : bounds[i + 1]]
            with np.errstate(over="ignore"):
                one = own.sum(dtype=np.uint64).view(np.int64)
                two = mixed(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)
            digest[:, i] = one, two
            if (int(one), int(two)) in seen:
                continue
            seen.add((int(one), int(two)))
            popularity[i] = often_i.mean()
            order = np.lexsort((own, often_i))
            least = [mixed(own + np.uint64(k + 1)).min() for k in range(HASH_KEYS)]
            blobs["keys"][i] = np.array(least, np.uint64).tobytes()
            blobs["shingles"][i] = own[order].tobytes()
            blobs["counts"][i] = often_i[order].astype(np.uint16).tobytes()
        yield {
            "doc_id": block.doc_ids, "n_shingles": sizes, "candidate": candidate,
            "set_one": digest[0], "set_two": digest[1], "popularity": popularity, **blobs,
        }

    merged = sketch.merge(blocks, lambda block: shingle_sets(block, words)[0])
    return blocks.with_answers(merged, describe, _SETS)


def _u64(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint64)


def _pivot_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (``a``, ``b``) of documents with the most popular one of a minimum hash they share."""

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        blobs = batch.column("keys").to_pylist()
        keys = np.frombuffer(b"".join(blobs), np.int64)
        times = np.repeat(np.arange(batch.num_rows), HASH_KEYS)
        number = np.tile(np.arange(HASH_KEYS), batch.num_rows)
        rows = batch.select(["rep", "popularity"]).take(pa.array(times))
        return pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(number, pa.int32()), pa.array(keys)],
            ["rep", "popularity", "number", "key"],
        )

    keyed = map_batches(
        sets.select("rep", "popularity", "keys"),
        spread,
        "rep long, popularity double, number int, key long",
    )
    best = F.max(F.struct(F.col("popularity"), (-F.col("rep")).alias("minus")))
    pivots = (
        keyed.groupBy("number", "key")
        .agg(best.alias("best"), F.count("*").alias("n"))
        .where("n > 1")
        .select("number", "key", (-F.col("best.minus")).alias("pivot"))
    )
    pairs = keyed.join(pivots, ["number", "key"]).where("rep <> pivot").select("rep", "pivot")
    pairs = pairs.distinct()
    of_rep = sets.select("rep", F.col("shingles").alias("mine"))
    of_pivot = sets.select(F.col("rep").alias("pivot"), F.col("shingles").alias("other"))

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = [
            similar(_u64(mine.as_py()), _u64(other.as_py()), percent)
            for mine, other in zip(batch.column("mine"), batch.column("other"), strict=True)
        ]
        chosen = batch.select(["rep", "pivot"]).filter(pa.array(keep, pa.bool_()))
        return chosen.rename_columns(["a", "b"])

    both = pairs.join(of_rep, "rep").join(of_pivot, "pivot")
    return map_batches(both.select("rep", "pivot", "mine", "other"), verify, "a long, b long")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _families(grouped: DataFrame, percent: int) -> DataFrame:
    """``group`` and ``family`` of groups that share a prefix shingle with another group."""

    def prefixes(batch: pa.RecordBatch) -> pa.RecordBatch:
        shingles, groups = [], []
        columns = (batch.column(c) for c in ("shingles", "counts", "group"))
        for blob, counts, group in zip(*columns, strict=True):
            own = _u64(blob.as_py())
            n = len(own) - needed(len(own), percent) + 1
            chosen = own[:n][np.frombuffer(counts.as_py(), np.uint16)[:n] >= 2]
            shingles.append(chosen)
            groups.append(np.full(len(chosen), group.as_py()))
        pairs = np.stack([np.concatenate(shingles).view(np.int64), np.concatenate(groups)], axis=1)
        pairs = np.unique(pairs, axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["shingle", "group"]
        )

    found = map_batches(
        grouped.select("shingles", "counts", "group"), prefixes, "shingle long, group long"
    )
    # most shingles belong to one group: see that before the groups of a shingle are listed
    shared = (
        found.groupBy("shingle")
        .agg(F.min("group").alias("least"), F.max("group").alias("most"))
        .where("least <> most")
    )
    links = found.join(shared, "shingle").select(
        F.col("group").alias("a"), F.col("least").alias("b")
    )
    return components(links.distinct()).select(
        F.col("node").alias("group"), F.col("component").alias("family")
    )


class _Groups:
    """Groups that documents belong to, joined as links are found."""

    def __init__(self, groups: np.ndarray):
        self.parent = {g: g for g in set(groups.tolist())}

    def root(self, group: int) -> int:
        while self.parent[group] != group:
            self.parent[group] = self.parent[self.parent[group]]
            group = self.parent[group]
        return group

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def adaptive_join(
    reps: list[int], groups: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Links that join the groups of documents on side 0 with those on side 1 (side 2: both).

    ``sets`` are in prefix order. A document that asks for ``l`` matches looks at its own prefix
    for ``l`` and at index entries that belong to the prefix for ``l`` of their document, so the
    two may ask for different ``l`` and a similar pair still has ``l`` shingles in common there.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    slack = sizes - needed(sizes, percent)
    indexed = np.minimum(slack + LONGEST, sizes)
    of = np.repeat(np.arange(n), indexed)
    level = np.arange(indexed.sum()) - np.repeat(np.cumsum(indexed) - indexed, indexed) - slack[of] + 1
    level = np.maximum(level, 1)
    tokens = np.concatenate([s[:k] for s, k in zip(sets, indexed.tolist(), strict=True)])
    order = np.argsort(tokens, kind="stable")
    tokens, of, level = tokens[order], of[order], level[order]
    start = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    distinct = tokens[start]
    list_length = np.diff(np.append(start, len(tokens)))
    known = _Groups(groups)
    ascending = [np.sort(s) for s in sets]
    links = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        at = np.searchsorted(distinct, sets[i][: indexed[i]])
        reach = np.cumsum(list_length[at])
        most = int(min(LONGEST, needed(int(sizes[i]), percent)))
        ends = np.minimum(slack[i] + np.arange(1, most + 1), sizes[i])
        matches = np.arange(1, most + 1)
        cost = reach[ends - 1] + VERIFY_COST * reach[ends - 1] / matches
        asked = int(cost.argmin()) + 1
        probes = at[: ends[asked - 1]]
        n_entries = list_length[probes]
        entry = np.repeat(start[probes] - (np.cumsum(n_entries) - n_entries), n_entries)
        entry = entry + np.arange(n_entries.sum())
        entry = entry[level[entry] <= asked]
        counts = np.bincount(of[entry], minlength=n)
        found = np.flatnonzero(counts >= asked)
        # each pair once, from its larger set; and only what can still join two groups
        larger = (sizes[found] < sizes[i]) | ((sizes[found] == sizes[i]) & (found > i))
        across = (sides[found] != sides[i]) | (sides[i] == 2)
        found = found[larger & across & (100 * sizes[found] >= percent * sizes[i])]
        mine = known.root(int(groups[i]))
        found = found[[known.root(g) != mine for g in groups[found].tolist()]]
        if not len(found):
            continue
        others = np.concatenate([ascending[j] for j in found.tolist()])
        place = np.minimum(np.searchsorted(ascending[i], others), sizes[i] - 1)
        hit = ascending[i][place] == others
        common = np.add.reduceat(hit, np.cumsum(sizes[found]) - sizes[found], dtype=np.int64)
        union = sizes[i] + sizes[found] - common
        for j in found[100 * common >= percent * union].tolist():
            if known.join(int(groups[i]), int(groups[j])):
                links.append((reps[i], reps[j]))
    return links


def _family_links(grouped: DataFrame, families: DataFrame, percent: int, tile: int) -> DataFrame:
    """Groups of one family (``a``, ``b``) that a link joins, found tile by tile."""
    rows = grouped.select("rep", "group").join(families, "group")
    group_size = rows.groupBy("family", "group").agg(F.count("*").alias("group_size"))
    family_size = group_size.groupBy("family").agg(
        F.sum("group_size").alias("family_size"),
        F.sum(F.when(F.col("group_size") < tile, F.col("group_size"))).alias("small_size"),
    )
    # a large group has tiles of its own, which need not be compared with each other
    own = (F.col("family_size") > tile) & (F.col("group_size") >= tile)
    parts = F.ceil(F.when(own, F.col("group_size")).otherwise(F.col("small_size")) / tile)
    dealt = F.when(own, F.xxhash64("rep")).otherwise(F.xxhash64("group"))
    number = F.when(F.col("family_size") > tile, F.pmod(dealt, parts)).otherwise(0).cast("long")
    rows = write_scratch(
        rows.join(group_size, ["family", "group"])
        .join(family_size, "family")
        .select(
            "rep", "group", "family",
            F.when(own, F.col("group")).otherwise(F.lit(NO_ID)).alias("owner"),
            number.alias("number"),
        ),
        "tiles",
    )
    tiles = rows.select("family", "owner", "number").distinct()
    left = tiles.select("family", F.struct("owner", "number").alias("x"))
    right = tiles.select("family", F.struct("owner", "number").alias("y"))
    jobs = (
        left.join(right, "family")
        .where("x <= y")
        .where((F.col("x.owner") != F.col("y.owner")) | (F.col("x.owner") == NO_ID))
        .withColumn("job", F.xxhash64("family", "x", "y"))
    )
    whole = jobs.where("x = y").select("family", F.col("x").alias("t"), "job", F.lit(2).alias("side"))
    pairs = jobs.where("x <> y")
    sides = [
        pairs.select("family", F.col(c).alias("t"), "job", F.lit(s).alias("side"))
        for s, c in enumerate("xy")
    ]
    wanted = whole.unionByName(sides[0]).unionByName(sides[1])
    work = (
        rows.select("rep", "group", "family", F.struct("owner", "number").alias("t"))
        .join(wanted, ["family", "t"])
        .select("rep", "group", "job", "side")
        .join(grouped.select("rep", "shingles"), "rep")
    )

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        links = adaptive_join(
            table.column("rep").to_pylist(),
            table.column("group").to_numpy(),
            table.column("side").to_numpy(),
            [_u64(x) for x in table.column("shingles").to_pylist()],
            percent,
        )
        of = dict(zip(table.column("rep").to_pylist(), table.column("group").to_pylist()))
        a, b = ([of[link[side]] for link in links] for side in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return work.groupBy("job").applyInArrow(run, "a long, b long")


def join(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, tile: int = TILE
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Two documents link when their sets of ``words``-word shingles (lower case A-Z, words apart by
    ASCII white space) have a Jaccard similarity of ``percent`` or more. A text with fewer words is
    one shingle; a null text or one without words has none and links with nothing. Rows with equal
    ids are one node. A null id links with nothing and has a null component. An empty table stays
    empty.
    """
    described = write_scratch(document_sets(docs, words, percent), "sets")
    of_set = ["set_one", "set_two", "n_shingles"]
    candidates = described.where("candidate")
    reps = candidates.groupBy(*of_set).agg(F.min("doc_id").alias("rep"))
    # one of the sets that equal documents carry, whichever block it comes from
    carried = candidates.where(F.col("shingles").isNotNull()).groupBy(*of_set).agg(
        F.first(F.struct("popularity", "keys", "shingles", "counts")).alias("set")
    )
    sets = write_scratch(reps.join(carried, of_set).select("rep", *of_set, "set.*"), "sets")
    members = candidates.select("doc_id", *of_set).join(sets.select("rep", *of_set), of_set)
    members = write_scratch(members.select("doc_id", "rep").distinct(), "members")
    # rows with one id and several texts are one node
    first_links = _pivot_links(sets, percent).unionByName(
        members.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    )
    groups = components(first_links).select(
        F.col("node").alias("rep"), F.col("component").alias("group")
    )
    grouped = sets.join(groups, "rep", "left").withColumn("group", F.coalesce("group", "rep"))
    grouped = write_scratch(grouped.select("rep", "group", "shingles", "counts"), "groups")
    families = _families(grouped, percent)
    more_links = _family_links(grouped, families, percent, tile)
    joined = components(more_links).select(
        F.col("node").alias("group"), F.col("component").alias("joined")
    )
    found = (
        members.join(groups.withColumnRenamed("rep", "doc_id"), "doc_id", "left")
        .select("doc_id", F.coalesce("group", "doc_id").alias("group"))
        .distinct()
        .join(joined, "group", "left")
        .select("doc_id", F.coalesce("joined", "group").alias("component"))
    )
    return described.select("doc_id", "n_shingles").join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
