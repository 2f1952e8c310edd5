"""License scans by diagonal voting.

Every run of ``GRAM`` words of a text is hashed and joined to the places where the same run stands
in a template. A hit votes for its diagonal, the place in the text minus the place in the template.
A phrase stands where a diagonal has all of its votes. Longer templates may be quoted with words
put in or left out, so neighbouring diagonals of one template are merged, and the merged span counts
when its votes cover enough of the template.

The hashes of a text come as one array from vectorised code; the join, the votes and the spans are
DataFrame operations. The templates are a fixed list, so what is broadcast does not grow with the
texts. Every text adds one row for itself (a sentinel that always joins) and one per hit; nothing
else is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skyledger.llm.blocks import RangeHash, Texts
from skyledger.llm.common import binary_column, text_groups, texts_of, write_scratch

GRAM = 3
#: Of the votes of a template that a merged span must have, and how far diagonals may lie apart.
COVERAGE = 0.8
DRIFT = 3

# The ASCII bytes that stand between words, after A-Z became a-z.
_APART = np.zeros(256, bool)
_APART[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    base: bool = False


# Base phrases and their labels.
BASE_TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)

# Wording of public licenses.
OWN_TEMPLATES = (
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl-3", "gnu affero general public license"),
    Template("mpl-2", "mozilla public license"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("all-rights-reserved", "all rights reserved"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files",
    ),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of"
        " the license at",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of"
        " the gnu general public license as published by the free software foundation",
    ),
    Template(
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
)
TEMPLATES = BASE_TEMPLATES + OWN_TEMPLATES
#: The hash and the template of the row that every text has.
_SELF_HASH, _SELF = 0, -1
KEY = ("id_key", "text_hash")


def gram_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``GRAM`` words, the number of runs and the number of words per text."""
    block = Texts(texts, _APART)
    n_words = np.bincount(block.words[2], minlength=len(block))
    rolling = RangeHash(block.word_hashes(0, lower=True), 1).rolling(GRAM)
    doc = block.words[2]
    inside = doc[: len(rolling)] == doc[GRAM - 1 :]
    return rolling[inside].view(np.int64), np.maximum(n_words - GRAM + 1, 0), n_words


def template_grams(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``gram_hash``, ``template`` (its number) and ``template_at``, a row per gram, and the row
    that every text joins."""
    if any(len(t.words.split()) < GRAM for t in templates):
        raise ValueError(f"a template needs at least {GRAM} words")
    hashes, sizes, _ = gram_hashes([t.words.encode() for t in templates])
    numbers = np.repeat(np.arange(len(templates)), sizes).tolist()
    places = [at for n in sizes.tolist() for at in range(n)]
    rows = [(_SELF_HASH, _SELF, 0), *zip(hashes.tolist(), numbers, places, strict=True)]
    return spark.createDataFrame(rows, "gram_hash long, template int, template_at int")


def hits(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Every (text, template, diagonal) with its votes, and a row with template ``_SELF`` per text."""
    grams = template_grams(docs.sparkSession, templates)
    texts = texts_of(docs).select(
        "doc_id",
        F.coalesce("doc_id", F.lit(-(2**63))).alias("id_key"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_groups(batch):
                hashes, sizes, n_words = gram_hashes(binary_column(part, "text"))
                # the row of the text itself goes before its grams
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                values = np.insert(hashes, bounds[:-1], _SELF_HASH)
                offsets = pa.array(bounds + np.arange(len(bounds)), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(values))
                columns = [part.column(c) for c in ("doc_id", *KEY)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(n_words, pa.int64()), lists],
                    ["doc_id", *KEY, "n_words", "grams"],
                )

    hashed = texts.mapInArrow(
        run, "doc_id long, id_key long, text_hash long, n_words long, grams array<long>"
    ).select("doc_id", *KEY, "n_words", F.posexplode("grams").alias("place", "gram_hash"))
    joined = hashed.join(F.broadcast(grams), "gram_hash")
    is_self = F.col("template") == _SELF
    # the sentinel stands at place 0, so words count from 1 here
    at_start = is_self == (F.col("place") == 0)
    return (
        joined.where(at_start)
        .groupBy(
            "doc_id", *KEY, "n_words", "template",
            F.when(is_self, 0).otherwise(F.col("place") - 1 - F.col("template_at")).alias("diagonal"),
        )
        .agg(
            F.count("*").alias("rows"),
            F.collect_set("template_at").alias("votes"),
        )
    )


def spans(found: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Verified spans: text keys, ``template``, ``start`` and ``stop`` in words, ``coverage``.

    A phrase of the base list needs every vote on one diagonal. Other templates may have their
    votes on diagonals that lie at most ``DRIFT`` apart each.
    """
    n_grams = F.array(*(F.lit(len(t.words.split()) - GRAM + 1) for t in templates))
    grams = F.element_at(n_grams, F.col("template") + 1)
    base = [i for i, t in enumerate(templates) if t.base]
    voted = found.where(F.col("template") != _SELF).withColumn("grams", grams)
    whole = voted.where((F.size("votes") == F.col("grams")) & F.col("template").isin(base)).select(
        *KEY,
        "template",
        F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("grams") + GRAM - 1).alias("stop"),
        F.lit(1.0).alias("coverage"),
    )
    by_diagonal = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    begins = (F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > DRIFT).cast("int")
    grouped = (
        voted.where(~F.col("template").isin(base))
        .withColumn("begins", F.coalesce(begins, F.lit(0)))
        .withColumn("cluster", F.sum("begins").over(by_diagonal))
    )
    merged = (
        grouped.groupBy(*KEY, "template", "cluster", "grams")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("votes"))).alias("votes"),
            F.min(F.col("diagonal") + F.array_min("votes")).alias("start"),
            F.max(F.col("diagonal") + F.array_max("votes") + GRAM).alias("stop"),
        )
        .withColumn("coverage", F.size("votes") / F.col("grams"))
        .where(F.col("coverage") >= COVERAGE)
    )
    return whole.unionByName(merged.select(*whole.columns))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words`` and ``found``, its verified spans as an array of
    ``(start, template, stop, coverage)``.

    A null text counts as empty and has no words. Repeated rows get a row each; a null ``doc_id``
    stays null. An empty table stays empty.
    """
    found = write_scratch(hits(docs, templates), "hits")  # small, and read three times
    span = F.struct("start", "template", "stop", "coverage")
    per_text = (
        spans(found, templates)
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_list(span)).alias("found"))
    )
    # one row per row of docs: the sentinel counts how often a text occurs
    texts = found.where(F.col("template") == _SELF).select("doc_id", *KEY, "n_words", "rows")
    none = F.array().cast("array<struct<start:int,template:int,stop:int,coverage:double>>")
    return (
        texts.join(per_text, list(KEY), "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
        .select("doc_id", "n_words", F.coalesce("found", none).alias("found"))
    )


def digests(scanned: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Counts and labels of the base phrases, labels of all templates and a score.

    The score is the largest coverage among the verified spans, 0 without one.
    """
    base_ids = [i for i, t in enumerate(templates) if t.base]
    label = F.array(*(F.lit(t.label) for t in templates))
    scanned = scanned.withColumn("base", F.filter("found", lambda s: s["template"].isin(base_ids)))

    def labels(column: str) -> Column:
        names = F.transform(column, lambda s: F.element_at(label, s["template"] + 1))
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda s: s["start"].cast("long"))).alias("first_word"),
        F.array_max(F.transform("base", lambda s: s["start"].cast("long"))).alias("last_word"),
        labels("base").alias("base_labels"),
        labels("found").alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["coverage"])), F.lit(0.0)).alias(
            "score"
        ),
    )
