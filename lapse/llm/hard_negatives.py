"""Hard-negative mining by Fagin's threshold algorithm over integer inner products.

Each cell of candidates is held as one sorted list per dimension. For an anchor the lists are read in step, from the
top where the anchor's component is positive and from the bottom where it is negative (sorted access); every row met
is scored in full (random access). No row that was not met can score above the threshold, the score of the
values last read; reading stops once the threshold is strictly below the kth score of each window asked for (or
below a window that has fewer than k rows). A first search finds an anchor's positives; their scores span the
windows of the second, which finds the negatives. The cells' first k are merged per window.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import staged
from lapse.llm.vectors import BLOCK_ROWS, CELL_ROWS, grid, matrix, numbered, parts_of

#: Rows read from each list at first; each further round reads this many times more.
FIRST_DEPTH, DEEPER = 64, 4
SCALE = 256
_ALL = -(1 << 62), 1 << 62


@dataclass
class Lists:
    """A cell's rows, and per dimension their order by value."""

    rows: np.ndarray     # (n, d), integral
    order: np.ndarray    # (2, d, n): rows by descending and by ascending value
    values: np.ndarray   # (2, d, n): these values


def scaled(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.floor(scale * vectors)


def exact_type(rows: np.ndarray, others: np.ndarray) -> type:
    """A number type in which no partial sum of an inner product of the two sides is rounded."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(others).sum(1).max(initial=0))
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def sorted_lists(rows: np.ndarray) -> Lists:
    up = np.argsort(rows, axis=0, kind="stable").T
    value = np.take_along_axis(rows.T, up, 1)
    return Lists(rows, np.stack([up[:, ::-1], up]).astype(np.int32), np.stack([value[:, ::-1], value]))


def search(lists: Lists, anchor: np.ndarray, windows: list[tuple[int, int]], k: int, allowed: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per window (least, most) the first k (score, row) of the allowed rows that score within it: by score
    downwards, then by row."""
    n, used = len(lists.rows), np.flatnonzero(anchor)
    used = used if len(used) else np.arange(1)  # without a direction every row scores 0: read one list to its end
    ends = (anchor[used] < 0).astype(np.int64)
    weight = anchor[used].astype(object if anchor.dtype == object else np.float64)
    met, scored = np.zeros(n, bool), np.zeros(n, bool)
    best = [(np.zeros(0, lists.rows.dtype), np.zeros(0, np.int64)) for _ in windows]
    depth, step = 0, FIRST_DEPTH
    while True:
        to = min(n, depth + step)
        met[lists.order[ends, used, depth:to].ravel()] = True
        fresh = np.flatnonzero(met & ~scored)
        scored[fresh] = True
        fresh = fresh[allowed[fresh]]
        score = lists.rows[fresh] @ anchor
        threshold = (weight * lists.values[ends, used, to - 1]).sum()
        done = to == n
        full = True
        for w, (least, most) in enumerate(windows):
            inside = (score <= most) & (score >= least)
            value, row = np.append(best[w][0], score[inside]), np.append(best[w][1], fresh[inside])
            if len(value) > k:
                high = value >= np.partition(value, len(value) - k)[len(value) - k]
                value, row = value[high], row[high]
                first = np.lexsort([row, -value])[:k]
                value, row = value[first], row[first]
            best[w] = value, row
            full &= bool(threshold < (value.min() if len(value) == k else least))
        if done or full or scored.all():
            return [sorted(((int(s), int(r)) for s, r in zip(*b)), key=lambda x: (-x[0], x[1])) for b in best]
        depth, step = to, step * DEEPER


def _ordered(cell: pa.Table) -> pa.Table:
    return cell.sort_by([("id", "ascending"), ("rid", "ascending")])


def _found(cell: pa.Table, anchors: pa.Table, hits: Iterable[tuple[int, int, int, int]]) -> pa.Table:
    """Rows of (anchor, window, score, candidate) with the names they have in the tables."""
    hits = list(hits)
    at, window, score, row = (pa.array([h[c] for h in hits], pa.int64()) for c in range(4))
    return pa.table({"anchor": anchors.column("rid").take(at), "w": window.cast(pa.int32()), "score": score,
                     "rid": cell.column("rid").take(row), "id": cell.column("id").take(row)})


def _meet(width: int, scale: int, k: int, same_label: bool):
    """A cogroup function that searches a cell for each anchor of a block."""

    def run(cell: pa.Table, anchors: pa.Table) -> pa.Table:
        if not cell.num_rows or not anchors.num_rows:
            return _found(cell, anchors, [])
        cell = _ordered(cell)
        rows, wanted = scaled(matrix(cell.column("vec"), width), scale), scaled(matrix(anchors.column("vec"), width), scale)
        kind = exact_type(rows, wanted)
        if kind is object:
            rows, wanted = (np.vectorize(int, otypes=[object])(x) for x in (rows, wanted))
        lists, wanted = sorted_lists(rows.astype(kind)), wanted.astype(kind)
        rid, mine = cell.column("rid").to_numpy(), anchors.column("rid").to_numpy()
        if not same_label:
            codes = pa.chunked_array([*cell.column("label").chunks, *anchors.column("label").chunks]).combine_chunks().dictionary_encode()
            code = codes.indices.to_numpy(zero_copy_only=False)
            spans = anchors.column("spans").to_pylist()
        hits = []
        for a in range(len(mine)):
            if same_label:
                windows, allowed = [_ALL], rid != mine[a]
            else:
                windows, allowed = [(s["least"], s["most"]) for s in spans[a]], code[:len(rid)] != code[len(rid) + a]
            for w, found in enumerate(search(lists, wanted[a], windows, k, allowed)):
                hits += [(a, w, s, r) for s, r in found]
        return _found(cell, anchors, hits)

    return run


def _first(found: DataFrame, k: int, by: list[str]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 5, percent: int = 80, scale: int = SCALE,
         cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per anchor and positive the nearest rows of other labels that score at least ``percent`` of the positive and no more than it:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is a condition on the columns id and label. A row's score is its inner product with the anchor, both
    with components floor(scale * x); higher scores come first, ties go by id (nulls last), then by place in the
    table. Positives are an anchor's first other rows of its label. Rows with a null label take no part, nor do those that
    ``numbered`` leaves out. Rows that repeat an id are rows of their own, also as anchors. A positive that scores
    below zero has no negatives, as its window is empty; one of score zero has those that score zero. An empty table, or one without anchors, gives
    no row. Components are exact at any size; scores beyond 64 bits raise an error. Other columns are not read.
    """
    spark = rows.sparkSession
    kept, width = numbered(rows.where(F.col(label_col).isNotNull()), id_col, vector_col, label_col, "negatives")
    kinds = dict(kept.dtypes)
    hit = f"anchor long, w int, score long, rid long, id {kinds['id']}"
    # positives: an anchor meets the rows of its own label only, a frequent label is cut into cells
    per_label = kept.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(anchor).alias("a")).where("a > 0").select(
        F.col("label").alias("of"), parts_of(F.col("n"), cell_rows).alias("cells"), parts_of(F.col("a"), block_rows).alias("blocks"))
    dealt = kept.join(per_label, F.col("label") == F.col("of")).drop("of")
    own = dealt.select("rid", "id", "vec", F.col("label").alias("key"), "cells", "blocks")
    left, right = grid(own, dealt.where(anchor).select("rid", "vec", F.col("label").alias("key"), "cells", "blocks"), ["key"])
    near = left.cogroup(right).applyInArrow(_meet(width, scale, positives, True), hit)
    pos = staged(_first(near, positives, ["anchor"]).select("anchor", (F.col("rank") - 1).alias("w"), F.col("score").alias("p"), F.col("id").alias("positive_id")), "positives")
    # negatives: all rows, whatever their label; one window per positive
    least = F.ceil(F.col("p") * percent / F.lit(100).cast("decimal(3,0)")).cast("long")
    spans = pos.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("w", least.alias("least"), F.col("p").alias("most")))).alias("spans"))
    anchors = staged(kept.where(anchor).join(spans, F.col("rid") == F.col("anchor")).select("rid", "label", "vec", "spans"), "anchors")
    counts = kept.select(F.count(F.lit(1)).alias("n"), F.count_if(anchor).alias("a")).first()
    deal = {"cells": parts_of(counts["n"], cell_rows), "blocks": parts_of(counts["a"], block_rows)}
    left, right = grid(kept.withColumns(deal), anchors.withColumns(deal), [])
    far = left.cogroup(right).applyInArrow(_meet(width, scale, negatives, False), hit)
    neg = _first(far, negatives, ["anchor", "w"]).select("anchor", "w", "rank", F.col("score").alias("negative_score"), F.col("id").alias("negative_id"))
    names = kept.where(anchor).select(F.col("rid").alias("anchor"), F.col("id").alias("anchor_id"))
    return neg.join(pos, ["anchor", "w"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("p").alias("positive_score"), "negative_score")
