"""``LAG(col) OVER (PARTITION BY k ORDER BY o1, o2, ...)`` with hot keys split.

A window partitioned by ``k`` sends all rows of a key to one task. Here the
rows of each key are cut into chunks by ranges of ``o1`` (boundaries from a
sample by hash; the chunk is monotone in the order, so the
order inside a key is chunk-major):

* inside a chunk the previous row comes from a window over (k, chunk);
* the first row of a chunk takes the last row of the key's previous
  non-empty chunk: the same window marks each chunk's last row, these rows make
  an edge table of one row per (k, chunk), and the lag over it sees at most ``buckets`` rows per key.

The join back is on (k, chunk), the same keys the window already
partitioned by, so the input is shuffled and sorted once. NULL ``o1`` sorts last (``ASC NULLS LAST``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .prefix import bucket_bounds, default_buckets, numeric_key, with_bucket


def chunked_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                prefix: str = "prev_", buckets: int | None = None, first_flag: str | None = None) -> DataFrame:
    """``df`` plus ``prefix + c`` = the previous row's ``c`` within ``keys`` by ``order`` (ascending).

    ``first_flag``: also add a boolean column of that name, true where the row has no predecessor.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    nb = buckets or default_buckets(df.sparkSession)
    key = numeric_key(F.col(order[0]), dict(df.dtypes)[order[0]])
    bounds = bucket_bounds(df.select(*keys, *order), key, nb)
    d = with_bucket(df, key, bounds, "_chunk")
    ordering = [F.col(o).asc_nulls_last() for o in order]
    w = Window.partitionBy(*keys, "_chunk").orderBy(*ordering)
    d = d.select("*", F.row_number().over(w).alias("_pos"), F.lead(F.lit(1)).over(w).isNull().alias("_edge"),
                 *[F.lag(c).over(w).alias(f"_lag_{c}") for c in cols])
    # the edge table: the last row of every (key, chunk), carried into the key's next chunk
    chain = Window.partitionBy(*keys).orderBy("_chunk")
    prev = d.where("_edge").select(*keys, "_chunk", F.struct(*cols).alias("_v")).select(
        *keys, "_chunk", F.lag("_v").over(chain).alias("_pv"))
    a, b = d.alias("a"), prev.alias("b")
    cond = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys] + [F.col("a._chunk") == F.col("b._chunk")]
    j = a.join(b, cond, "left")
    out = [F.col(f"a.{c}") for c in df.columns]
    out += [F.when(F.col("a._pos") == 1, F.col(f"b._pv.{c}")).otherwise(F.col(f"a._lag_{c}")).alias(prefix + c)
            for c in cols]
    if first_flag:
        out.append(((F.col("a._pos") == 1) & F.col("b._pv").isNull()).alias(first_flag))
    return j.select(*out)
