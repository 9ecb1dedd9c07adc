"""A training corpus from raw documents in five stages; each is written as Parquet and read again by the next.

Every stage works on all that the one before kept, and its decisions take effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.llm import decontaminate, line_dedup, mixing, ngram_join, toxicity
from deltaloom.llm.shared import fresh, run_dir, table, words_of

TOXIC = 0.7
LEAST_LEFT = 0.1


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC stay; the model is trained on this stage's own input and the labels."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col(fresh(docs.columns, "_score")) < TOXIC).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat go, but one of each group; so does a document of which less than LEAST_LEFT of its words is left.

    Such a rest is no document any more, but scraps of a copy, which the next stage could no longer tell by its likeness.
    """
    words = fresh(docs.columns, "_words")
    done, removed = line_dedup.dedup_lines(docs.withColumn(words, words_of(F.col("text")))), fresh([*docs.columns, words], "_removed")
    some = F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]") & (words_of(F.col("text")) >= LEAST_LEFT * F.col(words))
    kept = done.where((F.col(removed) == 0) | some)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    found = ngram_join.ngram_join(docs).result
    others = found.where(F.col("id") != F.col("component_id")).select(F.col("id").alias("_other")).distinct()
    return docs.join(others, F.col("doc_id") == F.col("_other"), "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs, keep=("doc_id", "source"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

#: The learnt, iterative and index stages can't be told in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = run_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
