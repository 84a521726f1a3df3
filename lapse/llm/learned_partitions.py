"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts by recursive bisection with pairwise swaps; a small
network learns, from a vector alone, how a vector's neighbours are spread over the parts. Every row of the table is indexed in
the part that the network finds most probable; a query is sent to its most probable parts, as many as held-out
vectors of the sample need for the asked recall, and there all rows are ranked by their exact cosine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.common import staged
from lapse.llm.vectors import BLOCK_ROWS, CELL_ROWS, empty, grid, matrix, numbered, parts_of

#: Vectors that partitions and network are fitted on; every row is indexed.
FIT_ROWS = 8_192
PARTITIONS, NEIGHBOURS, HIDDEN, EPOCHS = 16, 10, 128, 30
#: Recall that held-out sample vectors must reach; the tables' recall is measured in the tests.
RECALL = 0.96
#: Least rows of the sample per partition.
_LEAST = 16


@dataclass
class Router:
    """A network of one hidden layer over unit vectors, and the number of partitions a query visits."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """(rows, partitions): partitions by falling probability, the lower index first of equal ones."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")


def unit(x: np.ndarray) -> np.ndarray:
    """Vectors of length 1. Each is first scaled by a power of two, so that no square over- or underflows."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """(rows, k) nearest other rows of unit vectors."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        score = x[a:a + 1024].astype(np.float32) @ x.T.astype(np.float32)
        score[np.arange(len(score)), np.arange(a, a + len(score))] = -2
        out[a:a + 1024] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def bisect(source: np.ndarray, target: np.ndarray, start: np.ndarray, rounds: int = 24) -> np.ndarray:
    """A side (0 or 1) for each node, halves of equal size: the start's lower half against its upper one, then
    improved by swaps of the nodes that gain most links within their side."""
    n = len(start)
    side = np.zeros(n, np.int64)
    side[np.argsort(start, kind="stable")[n // 2:]] = 1
    best, least, share = side.copy(), np.inf, 0.5
    for _ in range(rounds):
        cross = side[source] != side[target]
        if cross.sum() < least:
            best, least = side.copy(), cross.sum()
        else:
            share /= 2
        gain = np.bincount(source, np.where(cross, 1, -1), n)
        left, right = (np.flatnonzero(side == s) for s in (0, 1))
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        pairs = min(len(left), len(right))
        good = int((gain[left[:pairs]] + gain[right[:pairs]] > 0).sum())
        move = int(np.ceil(good * share))
        if not move or share < 0.02:
            break
        side[left[:move]], side[right[:move]] = 1, 0
    return best


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int) -> np.ndarray:
    """A part for each node of the neighbour graph; ``parts`` is a power of two, parts differ by one node per level."""
    source = np.repeat(np.arange(len(x)), near.shape[1])
    source, target = np.append(source, near.ravel()), np.append(near.ravel(), source)  # both directions
    part = np.zeros(len(x), np.int64)
    for _ in range(int(np.log2(parts))):
        out = part * 2
        for p in np.unique(part):
            nodes = np.flatnonzero(part == p)
            place = np.full(len(x), -1)
            place[nodes] = np.arange(len(nodes))
            inside = (place[source] >= 0) & (place[target] >= 0)
            own = x[nodes] - x[nodes].mean(0)
            out[nodes] += bisect(place[source[inside]], place[target[inside]], own @ np.linalg.eigh(own.T @ own)[1][:, -1])
        part = out
    return part


def train_router(x: np.ndarray, wanted: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 11) -> Router:
    """Cross-entropy against the shares of a vector's neighbours per partition (Adam, decayed weights)."""
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], wanted.shape[1]
    weights = [rng.standard_normal((d, hidden)) * np.sqrt(2), np.zeros(hidden), rng.standard_normal((hidden, parts)) / np.sqrt(hidden), np.zeros(parts)]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    size, step = min(256, len(x)), 0
    total = epochs * -(-len(x) // size)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(x), size):
            batch, share = x[order[k:k + size]], wanted[order[k:k + size]]
            step += 1
            inner = np.maximum(batch @ weights[0] + weights[1], 0)
            out = inner @ weights[2] + weights[3]
            out = np.exp(out - out.max(1, keepdims=True))
            error = (out / out.sum(1, keepdims=True) - share) / len(batch)
            back = (error @ weights[2].T) * (inner > 0)
            rate = 0.01 * (1 - (step - 1) / total)
            for i, g in enumerate((batch.T @ back, back.sum(0), inner.T @ error, error.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                weights[i] -= rate * (m[i] / (1 - 0.9 ** step) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8) + 1e-3 * weights[i])
    return Router(*weights)


def fit(sample: np.ndarray, k: int = 5, recall: float = RECALL, partitions: int = PARTITIONS) -> Router:
    """A router from unit vectors. One vector in five is held out: their neighbours among all vectors of the sample tell how many
    partitions a query must visit."""
    parts = 1 << int(np.log2(max(1, min(partitions, len(sample) // _LEAST))))
    if parts == 1:
        d = sample.shape[1]
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    held = np.arange(len(sample)) % 5 == 0
    x = sample[~held]
    near = neighbours(x, min(NEIGHBOURS, len(x) - 1))
    part = balanced_parts(x, near, parts)
    wanted = np.zeros((len(x), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1.0 / near.shape[1])
    router = train_router(x, wanted)
    score = sample[held] @ sample.T
    score[np.arange(len(score)), np.flatnonzero(held)] = -2
    truth = np.argpartition(-score, k - 1, axis=1)[:, :k]
    order = router.ranked(sample)
    place = np.argsort(order[held], axis=1)  # when a partition comes up for a query
    visited = np.take_along_axis(place, order[:, 0][truth], 1)
    reached = np.cumsum(np.bincount(visited.ravel(), minlength=parts)) / visited.size
    router.probes = min(parts, int(np.searchsorted(reached, recall)) + 1)
    return router


def _route(router: Router, width: int, probes: int):
    """A mapInArrow function: each row with its most probable partitions."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                order = router.ranked(unit(matrix(batch.column("vec"), width)))[:, :probes].astype(np.int32)
                parts = pa.ListArray.from_arrays(pa.array(np.arange(0, order.size + 1, order.shape[1]), pa.int32()), pa.array(order.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, parts], [*batch.schema.names, "parts"])

    return run


def _nearest(width: int, k: int):
    """A cogroup function: the k rows of a cell with the largest cosine to each query of a block, ties by id."""

    def run(cell: pa.Table, queries: pa.Table) -> pa.Table:
        ids = cell.column("id").type
        if not cell.num_rows or not queries.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "rid": pa.array([], pa.int64()), "id": pa.array([], ids)})
        cell = cell.sort_by([("id", "ascending"), ("rid", "ascending")])
        rows, wanted = unit(matrix(cell.column("vec"), width)), unit(matrix(queries.column("vec"), width))
        rid, own = cell.column("rid").to_numpy(), queries.column("rid").to_numpy()
        query, row, score = [], [], []
        for a in range(0, len(wanted), 256):
            near = wanted[a:a + 256] @ rows.T
            near[own[a:a + 256, None] == rid] = -3
            bar = np.partition(near, -k, axis=1)[:, -k] if len(rid) > k else near.min(1)
            for q in range(len(near)):
                # products of a block may differ in the last place from row to row: near ties are summed again in one order
                close = np.flatnonzero((near[q] >= bar[q] - 1e-12) & (near[q] > -2))
                exact = (rows[close] * wanted[a + q]).sum(1)
                first = np.lexsort([close, -exact])[:k]
                query += [own[a + q]] * len(first)
                row.append(close[first])
                score.append(exact[first])
        at = pa.array(np.concatenate(row) if row else np.zeros(0, np.int64))
        return pa.table({"query": pa.array(query, pa.int64()), "score": pa.array(np.concatenate(score)), "rid": cell.column("rid").take(at), "id": cell.column("id").take(at)})

    return run


def nearest(rows: DataFrame, query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, recall: float = RECALL,
            fit_rows: int = FIT_ROWS, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k nearest rows found for each query, by cosine: query_id, rank, vec_id, score, and the partitions visited.

    ``query`` is a condition on the column id. Candidates are all rows but the query itself; rows that repeat an id or a vector are candidates of
    their own. Zero vectors and rows that ``numbered`` leaves out take no part. Ties go by id (nulls last), then by place in the table. Fewer
    candidates than k, as in small tables, give fewer rows; an empty table gives none. The router is fitted on at most ``fit_rows`` rows, by order of
    a hash of id and vector; all rows are indexed, and a partition however large is searched in cells of ``cell_rows``. Other columns are not read.
    """
    spark = rows.sparkSession
    whole = rows.where(F.exists(vector_col, lambda x: x != 0))
    kept, width = numbered(whole, id_col, vector_col, None, "neighbours")
    kinds = dict(kept.dtypes)
    out = f"query_id {kinds['id']}, rank int, vec_id {kinds['id']}, score double, probes int"
    sample = kept.orderBy(F.xxhash64("id", "vec"), "rid").select("vec").limit(fit_rows).collect()
    if not sample:
        return empty(spark, out)
    router = fit(unit(np.array([r["vec"] for r in sample], np.float64)), k, recall)
    schema = f"rid long, id {kinds['id']}, vec {kinds['vec']}, parts array<int>"
    base = kept.select("rid", "id", "vec")
    index = staged(base.mapInArrow(_route(router, width, 1), schema).withColumn("part", F.element_at("parts", 1)).drop("parts"), "index")
    asked = staged(base.where(query).mapInArrow(_route(router, width, router.probes), schema).withColumn("part", F.explode("parts")).drop("parts"), "asked")
    # a row per partition, of which there are PARTITIONS at most
    held = {r["part"]: r["n"] for r in index.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    sent = {r["part"]: r["n"] for r in asked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}

    def dealt(df: DataFrame) -> DataFrame:
        def of(counts: dict[int, int], size: int) -> Column:
            return F.element_at(F.create_map(*[F.lit(x) for p in range(len(router.b2)) for x in (p, max(1, -(-counts.get(p, 0) // size)))]), F.col("part"))
        return df.withColumns({"cells": of(held, cell_rows), "blocks": of(sent, block_rows)})

    left, right = grid(dealt(index), dealt(asked.select("rid", "vec", "part")), ["part"])
    found = left.cogroup(right).applyInArrow(_nearest(width, k), f"query long, score double, rid long, id {kinds['id']}")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = kept.where(query).select(F.col("rid").alias("query"), F.col("id").alias("query_id"))
    return first.join(names, "query").select("query_id", "rank", F.col("id").alias("vec_id"), "score", F.lit(router.probes).alias("probes"))
