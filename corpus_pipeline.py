"""A training-data pipeline over ``documents``: five operators of lapse.llm, one after another.

Each stage takes (spark, docs, sf_dir) and returns what its operator keeps; between stages the rows are
written as Parquet in the shared folder and read again. All stages but the last return the
columns of documents; the last returns the mix: one row per document with its copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapse.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from lapse.llm.common import ship_package, staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_dedup.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

#: Trained models, sketches and rounding have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
