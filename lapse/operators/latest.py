"""First/last row per group without a window sort.

``latest_per`` answers ``SELECT DISTINCT ON (k) ... ORDER BY k, o1 DESC, o2 DESC``
with one ``max(struct)`` aggregate. Unlike ``row_number() OVER (PARTITION BY k)``
it combines map-side: each task ships at most one row per key to the
shuffle, so a key holding a third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .argmax import argmax_columns


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str], nulls_greatest: bool = True,
               columns: Sequence[str] | None = None, packed: bool = False) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` tuple.

    ``packed``: ``order`` is a date and an id that no two rows of a group share, in the ranges that
    :mod:`lapse.operators.argmax` packs into one number; the rows are then found by hash aggregation, without a sort.

    ``nulls_greatest`` makes a NULL order value win over any value, which is
    PostgreSQL's ``DESC`` (NULLS FIRST) behaviour. Remaining ties are broken
    by the full row, so the result is deterministic.
    """
    payload = [c for c in (columns or df.columns) if c not in keys]
    if packed:
        aggregates, outputs = argmax_columns(df, order, payload)
        return df.groupBy(*keys).agg(*aggregates).select(*keys, *outputs)
    fields = []
    for i, c in enumerate(order):
        null_flag = F.col(c).isNull() if nulls_greatest else F.col(c).isNotNull()
        fields += [null_flag.alias(f"_n{i}"), F.col(c).alias(f"_o{i}")]
    packed = F.struct(*fields, F.struct(*payload).alias("_row"))
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best._row.{c}").alias(c) for c in payload])


def earliest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple (NULLs last)."""
    payload = [c for c in (columns or df.columns) if c not in keys]
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_o{i}")]
    packed = F.struct(*fields, F.struct(*payload).alias("_row"))
    best = df.groupBy(*keys).agg(F.min(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best._row.{c}").alias(c) for c in payload])
