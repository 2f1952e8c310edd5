"""The queries of the operators with production parameters, over whole tables."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import (
    bpe,
    credentials,
    fingerprint,
    jaccard,
    language,
    licenses,
    manifest,
    oracles,
    packing,
    substrings,
    suffixes,
    twofit,
    vectors,
    whitening,
)
from skyledger.llm.common import documents
from skyledger.llm.shipping import shipped

BPE_JSON = "byte_bpe_50k.json"
BPE_RANKS = "byte_bpe_50k.tiktoken"
WORD_JSON = "word_bpe_49k.json"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op2_small_world_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), public_tokenizers.path(BPE_JSON))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


def op4_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(BPE_RANKS)
    pattern = public_tokenizers.PATTERN
    return bpe.encode(documents(spark, sf_dir), ranks, pattern, decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_adaptive_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir), words=4, percent=85)


def op6_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digests(licenses.scan(documents(spark, sf_dir)))


HELD_OUT_OF = 5


def op7_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_OF == 0
    model = language.fit(docs.where(~held_out))
    return language.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = fingerprint.edit_study(documents(spark, sf_dir))
    return study.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op10_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digests(credentials.scan(documents(spark, sf_dir)))


def op11_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = twofit.pack(documents(spark, sf_dir), public_tokenizers.path(WORD_JSON))
    return pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "sequence_id", "offset",
    )


TAMPERED_OF = 3


def op13_incremental_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_OF == 0
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    rows = manifest.manifest(documents(spark, sf_dir), F.when(tampered, lower))
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(manifest.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: shipped(query)
    for query in (
        op1_substring_dedup,
        op2_small_world_links,
        op3_harmonic_packing,
        op4_bpe_replay,
        op5_adaptive_jaccard,
        op6_license_diagonals,
        op7_kneser_ney_language,
        op8_suffix_dedup,
        op9_merkle_fingerprint,
        op10_linked_secrets,
        op11_feast_whitening,
        op12_best_two_fit,
        op13_incremental_manifest,
    )
}

#: Queries that SQL cannot express, or not over whole tables in useful time, have none.
ORACLE_SQL_OF_QUERIES: dict[str, str] = {
    "op1_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op2_small_world_links": oracles.SMALL_WORLD_LINKS,
    "op5_adaptive_jaccard": oracles.ADAPTIVE_JACCARD,
    "op13_incremental_manifest": oracles.INCREMENTAL_MANIFEST,
}
