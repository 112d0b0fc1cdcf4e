"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, source mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of documents (more columns pass through, whatever their names); the
last returns one row per document with what the mix takes of it.  Every stage
gives an empty result for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm import decontaminate, line_dedup, mixing, quality_rules, simhash_dedup
from pulse.llm.common import save, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null, empty and blank texts have fewer than the least words and go; very
    long texts are judged whole; a null language or source is a group of its
    own; repeated rows and ties are judged alike and stay or go together."""
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; n_chars follows the text.

    No row goes: a null text stays null (n_chars null), one that loses all its
    lines becomes empty; a null source is a site of its own; repeated rows are
    pages of their site each; very long texts are cut line by line, whole."""
    return line_dedup.drop_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id.

    Null, empty and blank texts have fingerprint zero and are one group; a null
    id counts as the largest; of repeated rows, and of rows of one id in one
    group, one stays; very long texts are fingerprinted whole."""
    return simhash_dedup.keep_one(docs, size=3, max_bits=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go.

    Null, empty and blank texts hold none and stay, as do all if the benchmark
    is empty; rows of a null or repeated id are told apart by their text;
    repeated rows go or stay together; every window of a very long text counts."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, target of the source, copies the mix takes, words taken.

    One row per input row, repeats included; null and empty texts have size 0
    and are taken 0 times in words; a null source is the last source; ties
    between documents of one length are broken by a seeded hash, so reruns agree."""
    return mixing.mix(docs).select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"))


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The covariance estimates, fingerprints and the knapsack have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
