"""Similarity self-join on edit distance: pairs of texts within ``max_edits``, without enumerating pairs.

* Prefix filter on q-grams. An edit changes at most q of a text's q-grams, so of two texts within k edits each
  keeps all but k * q of its grams. With the grams of a text in one global order, rarest first, the first
  k * q + 1 of either text (its prefix) then hold the rarest gram that both kept: candidates are the texts that
  share a prefix gram, at places at most k apart, with lengths at most k apart (the length is part of the join key).
* Texts with no more than k * q grams may keep none. They are short, and so are their partners: both have at most
  a few dozen distinct remainders after up to k deletions, and texts within k edits share one.
* What remains is compared by an edit distance that stops beyond k (a band of 2 k + 1 diagonals).

Both joins go through :func:`grid_join`: no gram, however frequent, is met by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grid import grid_join

#: A character put before and behind a text so that its ends have grams too.
PAD = "\u0001"


def positional_grams(text: Column, q: int) -> Column:
    """All (gram, place) of the padded text: length + q - 1 of them."""
    pad = F.lit(PAD * (q - 1))
    whole = F.concat(pad, text, pad)
    return F.transform(F.sequence(F.lit(1), F.length(text) + F.lit(q - 1)),
                       lambda i: F.struct(F.substring(whole, i, F.lit(q)).alias("gram"), i.alias("place")))


def remainders(text: Column, deletions: int) -> Column:
    """The distinct texts left after up to ``deletions`` characters are taken out."""
    def shorter(texts: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(texts, lambda t: F.when(
            F.length(t) > 0, F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(
                F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))).otherwise(F.array().cast("array<string>")))))

    out = level = F.array(text)
    for _ in range(deletions):
        level = shorter(level)
        out = F.concat(out, level)
    return F.array_distinct(out)


def prefixes(texts: DataFrame, max_edits: int, q: int) -> DataFrame:
    """(text, len, gram, place): each text's ``max_edits * q + 1`` rarest grams, by the number of texts' places that hold them."""
    grams = texts.select("text", F.explode(positional_grams(F.col("text"), q)).alias("g")).select("text", "g.gram", "g.place")
    held = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    first = grams.join(held, "gram").groupBy("text").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("held", "gram", "place"))), 1, max_edits * q + 1).alias("first"))
    return first.select("text", F.length("text").alias("len"), F.explode("first").alias("g")).select("text", "len", "g.gram", "g.place")


def similar_texts(df: DataFrame, text_col: str, max_edits: int = 3, q: int = 2, rows_per_task: int = 4096) -> DataFrame:
    """Pairs of different texts of ``df`` within ``max_edits`` single-character edits: text_a < text_b, distance.

    Texts that repeat count once, NULL texts not at all; the empty text is a text. Characters are code points.
    """
    texts = df.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull()).distinct()
    k, few = max_edits, max_edits * q - (q - 1)  # texts of at most ``few`` characters have no more than k * q grams
    size = F.length("text")

    # longer texts: the shorter one's length is the key, the longer one is copied to the lengths it may meet
    long = prefixes(texts.where(size > few), k, q)
    lesser = long.select("gram", F.col("len").alias("at"), F.col("text").alias("ta"), F.col("place").alias("pa"))
    greater = long.select("gram", F.explode(F.sequence(F.greatest(F.lit(0), F.col("len") - k), F.col("len"))).alias("at"),
                          F.col("text").alias("tb"), F.col("place").alias("pb"), F.col("len").alias("lb"))
    met = grid_join(lesser, greater, ["gram", "at"], F.col("ta"), F.col("tb"), rows_per_task).where(
        (F.abs(F.col("pa") - F.col("pb")) <= k) & ((F.col("at") < F.col("lb")) | (F.col("ta") < F.col("tb")))).select("ta", "tb")

    # short texts against short and slightly longer ones
    near = texts.where(size <= few + k).select("text", F.explode(remainders(F.col("text"), k)).alias("left_over"))
    one = near.where(size <= few).select("left_over", F.col("text").alias("ta"))
    other = near.select("left_over", F.col("text").alias("tb"))
    met_short = grid_join(one, other, ["left_over"], F.col("ta"), F.col("tb"), rows_per_task).where(
        (F.length("tb") > few) | (F.col("ta") < F.col("tb"))).select("ta", "tb")

    # a pair met under several keys is compared each time, but only close ones are brought together
    close = met.unionByName(met_short).withColumn("distance", F.levenshtein("ta", "tb", k)).where(F.col("distance") >= 0)
    return close.select(F.least("ta", "tb").alias("text_a"), F.greatest("ta", "tb").alias("text_b"), "distance").distinct()
