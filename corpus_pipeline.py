"""From raw documents to tokens: the stages of a training corpus, each on all rows that the one before it kept.

``run`` writes each stage's rows as Parquet in the shared folder and reads them again for the next one, so a lost executor
costs at most the unfinished tasks of one stage; a stage's scratch tables, and the stage before it, go when it is written. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loyalflow.llm import bpe, exact_dedup, jaccard_join, source_mixing, toxicity
from loyalflow.llm.shared import remove, scratch, scratch_path, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted to the labelled ones among them, doesn't reject."""
    ship(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    ship(spark)
    return exact_dedup.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the least doc_id."""
    ship(spark)
    return jaccard_join.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks, in shuffled order."""
    return source_mixing.mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    ship(spark)
    return bpe.encode(docs, bpe.vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("op6_toxicity", without_toxic),
    ("op10_exact_dedup", without_copies),
    ("op2_ngram_jaccard_join", without_near_copies),
    ("op5_source_mixing", mixed),
    ("op9_bpe", tokens),
]

#: Neither a fitted model nor byte pairs can be said in SQL; a test holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with scratch(spark):  # a stage's own tables go with it
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
