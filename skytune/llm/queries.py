"""The operators of this subpackage as queries over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytune.llm import (
    alignment,
    bpe,
    decontaminate,
    fingerprint,
    kneser_ney,
    licenses,
    lines,
    minhash,
    packing,
    repeats,
    tokencount,
    toxicity,
    whitening,
)
from skytune.session import ship_package, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op8_line_dedup": lines.ORACLE}

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(ship_package(spark), folder)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_bpe_coding(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.coding_report(table(spark, folder, "documents"), WORD_VOCABULARY)


@query
def op2_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_groups(table(spark, folder, "documents"), percent=85, rows=4)


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.license_notices(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.size("notices").cast("long").alias("n_notices"),
        F.array_sort(F.array_distinct("notices.license")).alias("licenses"),
        F.col("notices.start").alias("starts"),
        F.col("notices.end").alias("ends"),
    )


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.scores(docs, labels, ~toxicity.held_out(F.col("doc_id"))).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.col("evidence.doc_id").alias("evidence"),
    )


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.contamination(docs, items).drop("mark")


@query
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_report(table(spark, folder, "documents"))


@query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.token_counts(table(spark, folder, "documents"), BYTE_VOCABULARY)


@query
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_report(table(spark, folder, "documents"))


@query
def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edit_report(table(spark, folder, "documents"))


@query
def op10_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return kneser_ney.language_scores(docs, kneser_ney.in_training(F.col("doc_id")))


@query
def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids and the id 1 in cost-balanced sequences of at most 2048 tokens."""
    pieces = packing.pack(table(spark, folder, "documents"), WORD_VOCABULARY, end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "cost",
    )


@query
def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Links and groups of the byte-level and the piece tokenizer in every document."""
    aligned = alignment.alignments(
        table(spark, folder, "documents"), BYTE_VOCABULARY, PIECE_MODEL
    )
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    kept = written(aligned.withColumn("groups_sha256", digest).drop("groups"), "alignments")
    size_b = alignment.vocabulary_size(PIECE_MODEL)
    counts = written(alignment.link_counts(kept, size_b), "link-counts")
    return alignment.with_link_counts(kept, counts)


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings on the first 16 principal components of the distinct ones."""
    return whitening.whitened(table(spark, folder, "embeddings"))
