"""The manifest against a tree built whole, and its blocks against small ones."""

from __future__ import annotations

import hashlib
import string

import pytest
from pyspark.sql import functions as F

from skyledger.llm import manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    values = (None if v is None else str(v) for v in row)
    return digest(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def climb(nodes):
    """The root of a list of nodes and the siblings of each, before and after, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at, strict=True):
            run = i // 8 * 8
            path.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 8])))
        nodes = [digest(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
        at = [i // 8 for i in at]
    return nodes[0], paths


def plain_manifest(rows):
    """(doc_id, lang, leaf, subroot, root, path) of (doc_id, source, lang, n_chars, text) rows."""
    def bytewise(lang):
        return (lang is not None, (lang or "").encode())

    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(row)))
    langs = sorted(trees, key=bytewise)
    folded = {lang: climb([leaf for *_, leaf in sorted(trees[lang])]) for lang in langs}
    root, above = climb([folded[lang][0] for lang in langs])
    return [
        (doc_id if named else None, lang, leaf, folded[lang][0], root, path + upper)
        for lang, upper in zip(langs, above, strict=True)
        for (named, doc_id, leaf), path in zip(sorted(trees[lang]), folded[lang][1], strict=True)
    ]


def found(frame):
    rows = frame.collect()
    return sorted(
        (
            (r.doc_id, r.lang, r.leaf, r.subroot, r.root,
             [(bytes(p.before).hex(), bytes(p.after).hex()) for p in r.path])
            for r in rows
        ),
        key=repr,
    )


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 65, 73, 513])
def test_appender(n):
    nodes = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(n)]
    tree = manifest.Appender()
    for node in nodes:
        tree.append(node)
    height = manifest.height_of(n, 4)
    root, paths = climb([x.hex() for x in nodes])
    assert tree.close(height).hex() == root
    before, after = tree.witnesses(height)
    told = [(b.hex(), a.hex()) for b, a in zip(before, after, strict=True)]
    assert told == [level for path in paths for level in path]


def test_odd_documents(spark, odd, odd_rows):
    rows = [(i, source, lang, n, text) for i, text, lang, source, n in odd_rows]
    result = manifest.manifest(odd)
    assert found(result) == sorted(plain_manifest(rows), key=repr)
    assert all(r.verified and r.folded_root == r.root for r in result.collect())


def test_empty_table_and_one_row(spark, none):
    assert manifest.manifest(none).collect() == []
    one = none.unionByName(spark.createDataFrame([(1, None, None, None, None)], none.schema))
    (row,) = manifest.manifest(one).collect()
    assert row.leaf == row.subroot == row.root == digest("1:1", *"----")
    assert row.path == [] and row.verified
    told = manifest.manifest(one).select(manifest.siblings(F.col("path")).alias("p")).first()
    assert told.p == ""


def test_many_blocks_and_repeated_rows(spark):
    """Blocks of eight nodes, so that four rounds are needed, with a language of most rows, many of
    them equal, and many languages of one row."""
    rows = [(i % 50 if i % 3 else 7, "s", "en", 1, "same" if i % 3 == 0 else f"t{i}") for i in range(700)]
    rows += [(i, None, f"l{i:02d}", None, "x") for i in range(70)] + [(None, None, "", None, "")]
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    frame = spark.createDataFrame(rows, schema).repartition(5).select(*names)
    assert found(manifest.manifest(frame, block_levels=1)) == sorted(plain_manifest(rows), key=repr)


def test_tampering_is_seen(spark, odd):
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    rows = manifest.manifest(odd, F.when(F.col("doc_id") == 12, lower)).collect()
    changed = [r for r in rows if r.doc_id == 12]
    assert changed and all(not r.verified and r.folded_root != r.root for r in changed)
    assert all(r.verified for r in rows if r.doc_id != 12)
    # nothing to change in a text without capitals
    same = manifest.manifest(odd, F.when(F.col("doc_id") == 19, lower)).collect()
    assert all(r.verified for r in same)
