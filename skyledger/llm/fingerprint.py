"""Document fingerprints: Merkle trees over words, paragraphs and sections.

A paragraph is a line. Its leaves are groups of words: four groups of four, then groups of sixteen.
A section is a run of paragraphs that ends where the digest of a paragraph says so, hence a
paragraph put in or taken out moves no section but its own. Every byte of the text lies in one leaf
or is a separator that the structure implies. The digest of a paragraph is that of its leaves'
digests, the digest of a section that of its paragraphs', and the root that of the sections', so
equal roots mean equal texts as far as 64-bit digests tell texts apart.

The fingerprint is text: version, root, then the digests of the leaves, ``,`` between leaves, ``/``
between paragraphs and ``;`` between sections. The whole tree follows from it (``tree_of``), so two
fingerprints can be compared from the root down without the texts, and a root that does not belong
to its branches is seen.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.common import TASK_BYTES, map_batches, shuffle_partitions, texts_of, total_bytes

VERSION = "m2"
SHORT_LEAF, SHORT_LEAVES, LONG_LEAF = 4, 4, 16
#: A section ends after a paragraph with a digest divisible by it: paragraphs per section.
SECTION = 4


_DIGEST_BYTES = 8


def _digest(data: bytes) -> str:
    return blake2b(data, digest_size=_DIGEST_BYTES).hexdigest()


def _leaves(paragraph: str) -> list[str]:
    words = paragraph.split(" ")
    head = SHORT_LEAF * SHORT_LEAVES
    cuts = [*range(0, min(len(words), head), SHORT_LEAF), *range(head, len(words), LONG_LEAF)]
    parts = [" ".join(words[a:b]) for a, b in zip(cuts, [*cuts[1:], len(words)], strict=True)]
    return [_digest(p.encode("utf-8", "surrogatepass")) for p in parts]


def _parent(children: list[str]) -> str:
    return _digest(",".join(children).encode())


def fingerprint_of(text: str) -> str:
    sections: list[list[str]] = [[]]
    digests: list[list[str]] = [[]]  # of the paragraphs of each section
    for paragraph in text.split("\n"):
        leaves = _leaves(paragraph)
        if digests[-1] and int(digests[-1][-1], 16) % SECTION == 0:
            sections.append([])
            digests.append([])
        sections[-1].append(",".join(leaves))
        digests[-1].append(_parent(leaves))
    body = ";".join("/".join(section) for section in sections)
    return f"{VERSION}:{_parent([_parent(d) for d in digests])}:{body}"


def tree_of(fingerprint: str) -> tuple[str, list[tuple[str, list[str]]]]:
    """Root, and the digest of each section with those of its paragraphs, computed from the leaves."""
    sections = [
        [_parent(paragraph.split(",")) for paragraph in section.split("/")]
        for section in fingerprint.split(":", 2)[2].split(";")
    ]
    digests = [_parent(paragraphs) for paragraphs in sections]
    return _parent(digests), list(zip(digests, sections, strict=True))


def is_sound(fingerprint: str) -> bool:
    """Whether the root is that of the leaves."""
    return _root(fingerprint) == tree_of(fingerprint)[0]


def _root(fingerprint: str) -> str:
    return fingerprint.split(":", 2)[1]


def likeness(a: str, b: str) -> float:
    """1 for equal roots, else the share of leaves that both have: two times the common leaves by
    the leaves of both. Sections that both have are taken whole, then paragraphs, then leaves."""
    if _root(a) == _root(b):
        return 1.0
    left, right = (Counter(x.split(":", 2)[2].split(";")) for x in (a, b))
    common = total = 0
    for separator in ("/", ",", None):
        both = left & right
        common += sum(n * _size(x) for x, n in both.items())
        if not total:
            total = sum(n * _size(x) for c in (left, right) for x, n in c.items())
        if separator is None:
            break
        left, right = (_parts(c - both, separator) for c in (left, right))
    return min(2 * common / total, 1 - 2**-20)  # never 1 for different texts


def _size(node: str) -> int:
    return node.count(",") + node.count("/") + 1


def _parts(nodes: Counter, separator: str) -> Counter:
    parts: Counter = Counter()
    for node, n in nodes.items():
        for part in node.split(separator):
            parts[part] += n
    return parts


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """Where ``a`` differs from ``b``: (section, paragraph) of every paragraph of ``a`` that has no
    equal in ``b``."""
    if _root(a) == _root(b):
        return []
    known_sections = Counter(b.split(":", 2)[2].split(";"))
    known = Counter(p for s in known_sections for p in s.split("/"))
    found = []
    for i, section in enumerate(a.split(":", 2)[2].split(";")):
        if known_sections[section] > 0:
            known_sections[section] -= 1
            continue
        for j, paragraph in enumerate(section.split("/")):
            if known[paragraph] > 0:
                known[paragraph] -= 1
            else:
                found.append((i, j))
    return found


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every whole text.

    A null text counts as empty. Repeated rows get a row each; a null ``doc_id`` stays null; an
    empty table stays empty.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint_of(t.as_py()) for t in batch.column("text")]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(prints, pa.string())], ["doc_id", "fingerprint"]
        )

    return map_batches(texts_of(docs), run, "doc_id long, fingerprint string")


def in_order(docs: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``doc_id``, ``text``, ``part``, ``extra`` for a pass over neighbours: partitioned by ``part``,
    which is a range of ids, in ascending order (nulls first, equal ids by text). Each part ends with
    the first document of the next part, marked ``extra``; the last one with the very first.

    Ranges come from quantiles of the ids; only their bounds pass through the driver.
    """
    texts = texts_of(docs)
    spark = docs.sparkSession
    n_parts = max(shuffle_partitions(spark), -(-total_bytes(texts) // task_bytes))
    probabilities = [i / n_parts for i in range(1, n_parts)]
    bounds = sorted(set(texts.approxQuantile("doc_id", probabilities, 0.1 / n_parts)))
    bounds_array = F.array(*(F.lit(int(b)).cast("long") for b in bounds))
    part = (
        F.coalesce(F.size(F.filter(bounds_array, lambda b: b <= F.col("doc_id"))), F.lit(0))
        if bounds
        else F.lit(0)
    )
    parted = texts.withColumn("part", part.cast("int"))
    first_ids = {
        r["part"]: r["first"]
        for r in parted.groupBy("part").agg(F.min("doc_id").alias("first")).collect()
        if r["first"] is not None
    }
    order = sorted(first_ids)
    handed = [(first_ids[p], order[i - 1]) for i, p in enumerate(order)]
    own = parted.withColumn("extra", F.lit(False))
    if handed:
        to = spark.createDataFrame(handed, "doc_id long, part int")
        firsts = texts.join(F.broadcast(to), "doc_id").withColumn("extra", F.lit(True))
        own = own.unionByName(firsts)
    return own.repartition(n_parts, "part").sortWithinPartitions("part", "extra", "doc_id", "text")


def edited_text(text: str, following: str) -> str:
    """The second half (rounded down) replaced by the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_study(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, with likenesses.

    The next document is the one with the next id (equal ids in the order of their texts, null ids
    before all others); after the last id comes the smallest. A single document follows itself.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held: tuple | None = None  # the last document whose neighbour is not known yet
        held_print = ""

        def study(doc_id: int, text: str, print_: str, following: str, next_print: str) -> None:
            edited = edited_text(text, following)
            edited_print = fingerprint_of(edited)
            rows.append(
                (doc_id, len(text), edited, print_, edited_print,
                 likeness(print_, edited_print), likeness(print_, next_print))
            )

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                     pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], STUDY_COLUMNS
            )

        size = 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "extra"))
            for doc_id, text, part, extra in zip(*columns, strict=True):
                if held is not None and held[2] != part:
                    study(held[0], held[1], held_print, held[1], held_print)  # no neighbour at all
                    held = None
                print_ = fingerprint_of(text)
                if held is not None:
                    study(held[0], held[1], held_print, text, print_)
                    size += len(held[1])
                held, held_print = (None, "") if extra else ((doc_id, text, part), print_)
                if size >= 4 << 20 or len(rows) >= 5000:
                    yield flush()
                    size = 0
        if held is not None:
            study(held[0], held[1], held_print, held[1], held_print)
        if rows:
            yield flush()

    schema = (
        "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )
    return in_order(docs).mapInArrow(run, schema)


STUDY_COLUMNS = [
    "doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
]
