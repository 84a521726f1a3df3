"""Equi-key + half-open interval join (events that fall in a per-row window).

Planned as a hash/sort-merge join on the equality key with the range test as
a residual condition: the range never drives the shuffle, so a bare
``a.t BETWEEN ...`` nested loop never appears. A hot key is split by AQE's
skew-join handling (the event side is chunked, the window side replicated).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day_number(c: Column) -> Column:
    return F.unix_date(F.to_date(c))


def interval_join(windows: DataFrame, events: DataFrame, keys: Sequence[str], point: str,
                  lower: Column, upper: Column, how: str = "inner", bucket_days: int | None = None) -> DataFrame:
    """Rows of ``windows`` joined to ``events`` with the same ``keys`` and
    ``lower <= events.point < upper`` (``lower``/``upper`` are expressions over
    ``windows`` columns). ``events`` columns other than the keys keep their names.

    ``bucket_days``: also join on a time bucket of that many days (use the window
    length). Each event gets the bucket of its day, each window row is repeated
    for the buckets its interval touches, and the exact range test stays as the
    residual, so every match is found once. A key with a long, dense history is
    then split across (key, bucket) partitions instead of landing in one task.
    Inner joins only.
    """
    w = windows.alias("w")
    e = events.alias("e")
    cond = [F.col(f"w.{k}") == F.col(f"e.{k}") for k in keys]
    if bucket_days:
        if how != "inner":
            raise ValueError("time buckets are for inner interval joins")
        b = int(bucket_days)
        first = F.floor(_day_number(lower) / b)
        last = F.floor(_day_number(upper) / b)
        w = w.select("*", F.explode(F.sequence(first, last)).alias("_tb")).alias("w")
        e = e.select("*", F.floor(_day_number(F.col(point)) / b).alias("_tb")).alias("e")
        cond.append(F.col("w._tb") == F.col("e._tb"))
    cond += [F.col(f"e.{point}") >= lower, F.col(f"e.{point}") < upper]
    out_cols = [F.col(f"w.{c}") for c in windows.columns] + \
               [F.col(f"e.{c}") for c in events.columns if c not in keys and c not in windows.columns]
    return w.join(e, on=cond, how=how).select(*out_cols)
