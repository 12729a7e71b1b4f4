"""Cleans a corpus in stages; every stage is written as Parquet and read again by the next.

A stage takes and returns the columns of documents; the last one returns token ids instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytune.llm import bpe, decontaminate, lines, minhash, toxicity
from skytune.llm.queries import WORD_VOCABULARY, table
from skytune.session import free_workers, release, ship_package, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more for toxicity go; held-out labels are not learned from."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.drop_toxic(docs, labels, ~toxicity.held_out(F.col("doc_id")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 and more code points that five or more documents hold stay in one of them."""
    free_workers(spark)  # this stage runs no Python, and its tasks need the memory
    kept = lines.drop_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    size = F.when(F.col("n_chars").isNotNull(), F.char_length("text"))
    return kept.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a likeness of 0.8 or more the one of the least id stays."""
    return minhash.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, numbers, names and units replaced or not, go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and what they decode to."""
    return bpe.round_trip(docs, WORD_VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", drop_benchmark),
    ("bpe_coding", bpe_coding),
]

#: No SQL expresses the vote of labelled neighbours or the merges of the vocabulary.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written before the next stage reads it."""
    docs = table(ship_package(spark), sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir), name)
        release(before)
    return docs
