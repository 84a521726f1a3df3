"""Ordered prefix counts inside groups, without sending a group to one task.

Given rows ``(groups..., value, c)`` -- distinct values with their row counts --
``prefix_counts`` adds ``_before``: how many rows of the same group come
strictly earlier in the order (ascending or descending; NULL is the largest
value, as in ``ASC NULLS LAST`` / ``DESC NULLS FIRST``), and ``_n``: the
group's total. Rank and order statistics follow directly:
``RANK = 1 + _before`` (descending), and the element at 0-based position k is
the value whose ``[_before, _before + c)`` covers k (ascending).

Work split: the values are cut into ``buckets`` ranges by boundaries from a sample
by hash (any monotone cut gives exact answers; the sample only balances work), so

* rows of the group in earlier buckets come from a prefix sum over a table of
  at most ``#groups x buckets`` rows, and
* rows in the same bucket come from a window over one (group, bucket) slice.

A group holding a third of all rows is spread over all buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F



def default_buckets(spark: SparkSession) -> int:
    """Value ranges per group: as many as the session's shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Rows sampled per bucket to place the cut points.
SAMPLE = 32


def bucket_bounds(df: DataFrame, value: Column, buckets: int) -> Column | None:
    """Up to ``buckets - 1`` ascending cut points of ``value`` (cast to double), as a scalar subquery of the plan.

    No job runs here: the cut points come from the rows of smallest hash, ``SAMPLE`` per bucket, when the plan that
    uses them runs. The sample depends on the rows alone, so wherever the plan works it out the cuts are the same.
    """
    if buckets <= 1:
        return None
    size = SAMPLE * buckets
    # nulls are sorted out rather than filtered: a filter would reach below an aggregate and make its plan another one
    sample = df.select(value.cast("double").alias("_v"), F.xxhash64(*df.columns).alias("_h")) \
        .orderBy(F.col("_v").isNull(), "_h", "_v").limit(size)
    some = sample.agg(F.array_sort(F.collect_list("_v")).alias("_s"))
    cuts = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(buckets - 1)), lambda i: F.try_element_at(
        "_s", (F.floor(i * F.size("_s") / buckets) + 1).cast("int"))))
    cut = some.select(F.filter(cuts, lambda x: x.isNotNull()).alias("all"))
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("all")))).cast("int")
    cut = cut.withColumn("width", width)
    first = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size("all") - 1) / F.col("width"))).cast("int"))
    cut = cut.select("all", "width", F.when(F.size("all") > 0, F.transform(first, lambda i: F.slice("all", i * F.col("width") + 1, F.col("width")))).otherwise(
        F.array().cast("array<array<double>>")).alias("table"))
    return cut.select(F.struct("width", F.size("all").alias("n"), "table", F.transform("table", lambda t: F.element_at(t, -1)).alias("tops"))).scalar()


def cut_table(bounds: Sequence[float]) -> Column:
    """Ascending cut points that are known, in the shape of ``bucket_bounds``."""
    width = math.isqrt(max(len(bounds) - 1, 0)) + 1
    stretches = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    lits = lambda xs: F.array(*[F.lit(float(x)) for x in xs]).cast("array<double>")
    return F.struct(F.lit(width).alias("width"), F.lit(len(bounds)).alias("n"),
                    F.array(*[lits(s) for s in stretches]).cast("array<array<double>>").alias("table"), lits([s[-1] for s in stretches]).alias("tops"))


def bucket_of(value: Column, cuts: Column | Sequence[float]) -> Column:
    """Ascending bucket index (monotone in ``value``), never null; NULL goes to the top bucket.

    The lookup has two levels of about sqrt(bounds) comparisons each: the last bound of each
    stretch first, then the stretch that the value falls in.
    """
    cuts = cuts if isinstance(cuts, Column) else cut_table(cuts)
    v = value.cast("double")

    def below(xs: Column) -> Column:
        return F.size(F.filter(xs, lambda x: x < v))

    which = below(cuts["tops"])
    within = F.coalesce(below(F.try_element_at(cuts["table"], which + 1)), F.lit(0))
    index = F.when(value.isNull(), cuts["n"] + 1).otherwise(F.least(which * cuts["width"], cuts["n"]) + within)
    # known not to be null: a join on it adds no filter, so the plans of its readers stay alike and share their exchanges
    return F.coalesce(index, F.lit(0))


def with_bucket(df: DataFrame, value: Column, bounds: Column | None, out: str) -> DataFrame:
    """``df`` plus each row's bucket."""
    if bounds is None:
        return df.withColumn(out, F.when(value.isNull(), F.lit(1)).otherwise(F.lit(0)))
    # a subquery may not stand inside a higher-order function
    return df.withColumn("_cuts", bounds).withColumn(out, bucket_of(value, F.col("_cuts"))).drop("_cuts")


def numeric_key(c: Column, dtype: str) -> Column:
    """A double that orders like ``c`` (dates and timestamps become day / second numbers)."""
    if dtype == "date":
        return F.unix_date(c).cast("double")
    if dtype == "timestamp_ntz":  # microseconds since the epoch, no time-zone step (monotone)
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), c).cast("double")
    if dtype.startswith("timestamp"):
        return F.unix_micros(c).cast("double")
    return c.cast("double")


def prefix_counts(vc: DataFrame, groups: Sequence[str], value: str, count: str = "_c",
                  descending: bool = False, buckets: int = 64) -> DataFrame:
    """``vc`` rows (distinct ``groups`` + ``value`` with ``count``) plus ``_before`` and ``_n``."""
    groups = list(groups)
    v = F.col(value)
    key = numeric_key(v, dict(vc.dtypes)[value])
    bounds = bucket_bounds(vc, key, buckets)  # its sample reads all columns, so that it shares the exchange behind ``vc``
    vcb = with_bucket(vc, key, bounds, "_b")
    per_bucket = vcb.groupBy(*groups, "_b").agg(F.sum(count).alias("_t"))
    earlier_first = F.col("_b").desc() if descending else F.col("_b").asc()
    running = Window.partitionBy(*groups).orderBy(earlier_first).rowsBetween(Window.unboundedPreceding,
                                                                               Window.currentRow)
    offsets = per_bucket.select(*groups, "_b", (F.sum("_t").over(running) - F.col("_t")).alias("_off"),
                                F.sum("_t").over(Window.partitionBy(*groups)).alias("_n"))
    in_order = v.desc_nulls_first() if descending else v.asc_nulls_last()
    local = Window.partitionBy(*groups, "_b").orderBy(in_order).rowsBetween(Window.unboundedPreceding, -1)
    within = vcb.withColumn("_in", F.coalesce(F.sum(count).over(local), F.lit(0)))
    w, o = within.alias("w"), offsets.alias("o")
    cond = [F.col(f"w.{g}").eqNullSafe(F.col(f"o.{g}")) for g in groups] + [F.col("w._b") == F.col("o._b")]
    keep = [F.col(f"w.{c}") for c in vc.columns]
    return w.join(o, cond).select(*keep, (F.col("o._off") + F.col("w._in")).alias("_before"), F.col("o._n"))
