"""A corpus pipeline in five stages, from documents to packed token sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on all documents that the stage before kept, and
returns documents with the columns of the table, the last one pieces of sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import credentials, jaccard, language, packing, suffixes
from skyledger.llm.common import documents, write_scratch
from skyledger.llm.shipping import shipped

TOKENIZER = "byte_bpe_50k.json"


@shipped
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language no model explains, and those without a letter. A null
    ``lang`` is filled with the prediction."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = language.identify(docs, language.fit(docs), keep=others)
    lang = F.coalesce("kept.lang", "lang_pred").alias("lang")
    columns = [
        F.col(c) if c in ("doc_id", "text") else lang if c == "lang" else F.col(f"kept.{c}")
        for c in docs.columns
    ]
    return found.where(~F.col("rejected")).select(columns)


@shipped
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows connected by similar shingle sets, the one with the smallest id; an id
    comes before a null one. Rows are told apart by id and text: equal rows count as one and leave
    one row, rows with one id and unlike texts do not stand for each other."""
    names = [F.col(c) for c in docs.columns]
    row = F.struct(*names)
    text = F.col("text").cast("string")
    keyed = docs.select(
        F.xxhash64("doc_id", "text").alias("node"),
        F.xxhash64(F.lit(1), "doc_id", "text").alias("check"),
        F.col("doc_id").alias("own_id"),
        text.alias("text"),
        row.alias("row"),
    )
    nodes = write_scratch(
        keyed.groupBy("node").agg(
            F.min("own_id").alias("own_id"),
            F.count("*").alias("n"),
            (F.min("check") == F.max("check")).alias("clear"),
        ),
        "nodes",
    )
    joined = jaccard.join(keyed.select(F.col("node").alias("doc_id"), "text"))
    joined = joined.select(F.col("doc_id").alias("node"), "component_id").distinct()
    placed = write_scratch(nodes.join(joined, "node"), "placed")
    rank = F.struct(F.col("own_id").isNull().alias("unnamed"), "own_id", "node")
    first = placed.groupBy("component_id").agg(F.min(rank).alias("first"))
    # two rows that share a node by chance are both kept
    gone = placed.where("clear").join(first.select("first.node"), "node", "left_anti")
    gone = write_scratch(gone.select("node"), "gone")
    repeated = placed.where("n > 1").select("node")
    left = keyed.join(gone, "node", "left_anti")
    once = left.join(repeated, "node", "left_anti").select("row")
    again = left.join(repeated, "node", "left_semi").groupBy("node", "check")
    # by their text, since rows may hold what has no order
    chosen = again.agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return once.unionByName(chosen).select("row.*")


@shipped
def repeated_text_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes or more that stand more than once; documents of which
    nothing is left go."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    left = suffixes.remove_repeats(docs, as_text=True, carry=others)
    left = left.where(~((F.col("n_removed") > 0) & (F.trim("kept") == "")))
    left = left.select("doc_id", F.col("kept").alias("text"), F.col("carried").alias("other"))
    chars = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    columns = [
        F.col(c) if c in ("doc_id", "text") else chars if c == "n_chars" else F.col(f"other.{c}")
        for c in docs.columns
    ]
    return left.select(columns)


@shipped
def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every reported secret replaced by a mark."""
    return credentials.redact(docs)


@shipped
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_text", repeated_text_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: The stages learn, search and tokenize; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again; the pieces of the last one."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE_SQL_OF_QUERIES: dict[str, str] = {}
