"""Per-group order statistics with the floor-index rule.

For a group with ``n`` sorted values, quantile ``q`` is the element at
0-based position ``floor(q * max(n - 1, 0))`` -- neither ``percentile`` nor
``percentile_disc``. Values are first collapsed to (group, value, count)
with a combinable aggregate; positions come from the bucketed prefix counts
of :mod:`lapse.operators.prefix`, so a group with a third of all rows is
still split across tasks and no per-group list is ever built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import default_buckets, prefix_counts


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))


def floor_index_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                          quantiles: Mapping[str, float], count_col: str | None = None,
                          buckets: int | None = None) -> DataFrame:
    """One row per group with non-null values: ``keys``, one column per quantile
    (and the non-null count as ``count_col`` when given)."""
    keys = list(keys)
    nb = buckets or default_buckets(df.sparkSession)
    ranked = prefix_counts(value_counts(df, keys, value), keys, value, descending=False, buckets=nb)
    aggs = []
    for name, q in quantiles.items():
        k = F.floor(F.lit(float(q)) * F.greatest(F.col("_n") - 1, F.lit(0)))
        # the value whose run of positions [_before, _before + c) contains k
        hit = (F.col("_before") <= k) & (k < F.col("_before") + F.col("_c"))
        aggs.append(F.max(F.when(hit, F.col(value))).alias(name))
    if count_col:
        aggs.append(F.max("_n").cast("bigint").alias(count_col))
    return ranked.groupBy(*keys).agg(*aggs)
