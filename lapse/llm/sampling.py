"""Bounded, repeatable samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a classifier is fitted on at most.
MAX_FIT_ROWS = 16_384


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids fall in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label_cols: list[str], id_col: str = "doc_id",
                    text_col: str = "text", max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """(doc_id, text, labels...) of at most ``max_rows`` labelled documents, by order of a hash of the id.

    Rows with a null id or a null label are not used; of labels that repeat an id the largest counts, of documents that
    repeat one the least text. The sample's ids are broadcast: ``max_rows`` bounds them whatever the tables' sizes.
    """
    known = labels.select(F.col(id_col).alias("lid"), *[F.col(c).cast("int").alias(f"y_{c}") for c in label_cols]).dropna()
    known = known.groupBy("lid").agg(*[F.max(f"y_{c}").alias(f"y_{c}") for c in label_cols])
    picked = known.orderBy(F.xxhash64("lid"), "lid").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("lid")).drop("lid")
    return named.groupBy("doc_id", *[f"y_{c}" for c in label_cols]).agg(F.min("text").alias("text")).select(
        "doc_id", "text", *[f"y_{c}" for c in label_cols])
