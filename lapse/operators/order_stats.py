"""Exact quantiles without sorting a column or holding it, or a group of it, in one task.

``percentile`` keeps a value->count map of a whole group in one task; a full sort shuffles every row. Here a
bounded ``approx_percentile`` sketch per group (combinable, fixed size) brackets the wanted ranks of all groups at
once, one pass counts the values below each bracket and those inside it -- a few rows per ten thousand --
and the positions inside come from bucketed prefix counts. All of it is one plan: no job runs
before the result is asked for, however many groups there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import default_buckets, prefix_counts

ACCURACY = 10_000
#: The sketch's ranks are right to 1 / ACCURACY of a group; the bracket reaches this many such steps to either side.
PAD = 3


def grouped_quantiles(df: DataFrame, keys: Sequence[str], col: str, quantiles: Mapping[str, float],
                      count_col: str | None = None, buckets: int | None = None) -> DataFrame:
    """Per group the linearly interpolated quantiles (``quantile_cont`` / pandas default) of a numeric column.

    One row per group with non-null values: ``keys``, a double per quantile and, if named, the number of values.
    ``keys`` may be empty: one row, or none where the column has no value. NULL is a group as in GROUP BY.
    """
    keys, names = list(keys), list(quantiles)
    group = keys or ["_all"]
    vals = df.withColumn("_all", F.lit(0)) if not keys else df
    vals = vals.select(*group, F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    ends = [min(1.0, max(0.0, q + side * PAD / ACCURACY)) for q in quantiles.values() for side in (-1, 1)]
    whole = F.col("_size") <= ACCURACY  # a step of the sketch may be less than a row: the bracket is the whole group
    sketch = vals.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"), F.approx_percentile("_v", ends, ACCURACY).alias("_e"))
    brackets = sketch.select(*[F.col(g).alias(f"_k{i}") for i, g in enumerate(group)], "_size", F.array(*[
        F.struct(F.lit(i).alias("q"), F.lit(float(q)).alias("at"), F.when(~whole, F.col("_e")[2 * i]).alias("lo"), F.when(~whole, F.col("_e")[2 * i + 1]).alias("hi"))
        for i, q in enumerate(quantiles.values())]).alias("_b"))
    if keys:
        near = vals.join(brackets, [F.col(g).eqNullSafe(F.col(f"_k{i}")) for i, g in enumerate(group)])
    else:  # one row: a value of the plan, no join
        near = vals.withColumn("_one", brackets.select(F.struct("_size", "_b")).scalar()).select(*group, "_v", "_one.*")
    met = near.select(*group, "_size", "_v", F.explode("_b").alias("_b")).where(F.col("_b.hi").isNull() | (F.col("_v") <= F.col("_b.hi")))
    # a row per value inside, and one, before all others, for the values below
    inside = F.col("_b.lo").isNull() | (F.col("_v") >= F.col("_b.lo"))
    value = F.when(inside, F.col("_v")).otherwise(F.lit(float("-inf")))
    counts = met.groupBy(*group, "_size", F.col("_b.q").alias("_q"), F.col("_b.at").alias("_at"), value.alias("_value")).agg(F.count(F.lit(1)).alias("_c"))
    placed = prefix_counts(counts, [*group, "_size", "_q", "_at"], "_value", buckets=buckets or default_buckets(df.sparkSession))
    h = (F.col("_size") - 1) * F.col("_at")

    def value_at(rank: Column, i: int) -> Column:
        holds = (F.col("_q") == i) & (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_c"))
        # by the sketch's guarantee every rank lies inside; were one outside, no value is better than a wrong one
        return F.coalesce(F.max(F.when(holds, F.col("_value"))), F.raise_error("a quantile lies outside its bracket").cast("double"))

    ends = [(value_at(F.floor(h), i).alias(f"_lo{i}"), value_at(F.ceil(h), i).alias(f"_hi{i}"))
            for i in range(len(names))]
    out = placed.groupBy(*group, "_size").agg(*[e for pair in ends for e in pair])
    values = []
    for i, (name, q) in enumerate(quantiles.items()):
        at = (F.col("_size") - 1) * F.lit(float(q))
        values.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (at - F.floor(at))).alias(name))
    return out.select(*keys, *values, *([F.col("_size").alias(count_col)] if count_col else []))


def quantile(df: DataFrame, col: str, q: float) -> Column:
    """One column's quantile as a scalar subquery of the plan that uses it; NULL where the column has no value."""
    return grouped_quantiles(df, [], col, {"q": q}).scalar()


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """One column's quantile as a number: runs a job."""
    row = grouped_quantiles(df, [], col, {"q": q}).first()
    return row["q"] if row is not None else None
