"""``RANK() OVER (PARTITION BY g ORDER BY v DESC)`` that does not put a group in one task.

A window partitioned by a low-cardinality key (a plan tier) sends each group
to a single task; a tier holding a third of all customers becomes one task
sorting a third of the table. Here ties are collapsed first -- (g, v) -> count,
a combinable aggregate, so a value shared by millions of rows is one row --
and ranks come from :func:`lapse.operators.prefix.prefix_counts`
(rank = 1 + rows of the group with a greater value). Ranks are joined back on
(g, v), null-safe; a hot (g, v) key is a one-row build side that AQE's
skew-join handling splits on the probe side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import default_buckets, prefix_counts


def rank_desc(df: DataFrame, groups: Sequence[str], value: str, out: str, buckets: int | None = None,
              materialize: bool = False) -> DataFrame:
    """``df`` plus ``out`` = RANK() within ``groups`` by ``value`` descending (NULLs rank first).

    ``materialize``: write the collapsed values into the shared checkpoint folder first, which runs a job.
    """
    groups = list(groups)
    n = buckets or default_buckets(df.sparkSession)
    # the collapsed table feeds the cut points and two branches, which share the exchange behind it
    vc = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_c"))
    vc = cut_lineage(vc) if materialize else vc
    ranks = prefix_counts(vc, groups, value, descending=True, buckets=n) \
        .select(*groups, value, (F.lit(1) + F.col("_before")).alias(out))
    base, r = df.alias("d"), ranks.alias("r")
    cond = [F.col(f"d.{g}").eqNullSafe(F.col(f"r.{g}")) for g in groups] + \
           [F.col(f"d.{value}").eqNullSafe(F.col(f"r.{value}"))]
    return base.join(r, cond).select("d.*", F.col(f"r.{out}").cast("bigint").alias(out))
