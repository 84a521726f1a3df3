"""Hard negatives, vector codes and learned partitions against brute force."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lapse.llm import code_cells, hard_negatives, learned_partitions
from lapse.llm import queries as Q

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")
#: Extra columns under the operators' own working names.
CLASH = {"rid": 1, "id": "i", "vec": 2, "key": 3, "cell": 4, "block": 5, "part": 6, "parts": 7, "cells": 8, "blocks": 9, "w": 1, "n": 2, "score": 3,
         "rank": 4, "anchor": 5, "code": "c", "error": 6, "of": 7, "p": 8, "query": 9}


def edge_vectors(dims=8, n=160, seed=3):
    """Ties, copies of rows and ids, null and unusable vectors, null labels, one label with a third of all rows."""
    r = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in r.integers(-3, 4, dims) / 4.0], 1 if i % 3 == 0 else int(r.integers(0, 12))) for i in range(n)]
    rows[40] = (40, rows[0][1], 1)
    rows += [(60, rows[60][1], rows[60][2])] * 3 + [(7, rows[8][1], 2), (100, rows[1][1], None), (None, rows[2][1], 1), (None, rows[2][1], 1)]
    rows += [(201, None, 1), (202, [0.5, None] + [0.0] * (dims - 2), 1), (203, [NAN] * dims, 1), (204, [INF] + [0.0] * (dims - 1), 1),
             (205, [], 1), (300, [0.0] * dims, 1), (206, [1.0] * (dims + 1), 1), (700, rows[5][1], None)]
    return rows


def usable(rows, dims=8):
    return [(i, v, y) for i, v, y in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]


def by_id(row):
    return (row[0] is None, row[0] or 0)


def brute_negatives(rows, every):
    rows = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in usable(rows) if y is not None]
    out = []
    for a, (ai, av, ay) in enumerate(rows):
        if ai is None or ai % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(av, v)), *by_id((i,)), i, y) for b, (i, v, y) in enumerate(rows) if b != a), key=lambda t: t[:3])
        for s, _, _, pid, _ in [t for t in scored if t[4] == ay][:5]:
            near = [t for t in scored if t[4] != ay and 80 * -s <= 100 * -t[0] <= 100 * -s][:5]
            out += [(ai, pid, n + 1, t[3], -s, -t[0]) for n, t in enumerate(near)]
    return sorted(out, key=str)


def every(n):
    return F.coalesce(F.col("id") % n == 0, F.lit(False))


@pytest.mark.parametrize("cells, blocks", [(1 << 14, 1 << 11), (13, 3)])
def test_hard_negatives_against_brute_force(spark, cells, blocks):
    rows = edge_vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({k: F.lit(v) for k, v in CLASH.items()})
    got = hard_negatives.mine(df, every(20), cell_rows=cells, block_rows=blocks)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows, 20)
    assert want and sorted((tuple(r) for r in got.collect()), key=str) == want


def test_hard_negatives_of_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(nothing, every(20)).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1), (2, [2.0], 2)], SCHEMA), every(20)).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(20, [1.0], 1), (3, None, 1)], SCHEMA), every(20)).count() == 0


def test_threshold_stops_reading_before_the_lists_end():
    r = np.random.default_rng(1)
    rows = np.floor(1000 * r.standard_normal((20_000, 3)))
    lists = hard_negatives.sorted_lists(rows)
    reads = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.dtype == np.int64:
                reads.append(len(key))
            return super().__getitem__(key)

    lists.rows = rows.view(Counted)
    anchor = np.array([3.0, -2.0, 1.0])
    score = rows @ anchor
    top = int(np.sort(score)[-50])
    found = hard_negatives.search(lists, anchor, [(-(1 << 62), 1 << 62), (top - 400, top)], 5, np.ones(len(rows), bool))
    order = np.lexsort([np.arange(len(rows)), -score])
    assert found[0] == [(int(score[i]), int(i)) for i in order[:5]]
    assert found[1] == [(int(score[i]), int(i)) for i in order if top - 400 <= score[i] <= top][:5]
    assert sum(reads) < len(rows) / 2


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 1 << 30), st.sampled_from([1, 2, 1 << 12, 1 << 40]))
def test_threshold_algorithm_equals_full_scoring(seed, scale):
    r = np.random.default_rng(seed)
    n, d = int(r.integers(1, 300)), int(r.integers(1, 6))
    rows = r.integers(-3, 4, (n, d)).astype(float) * scale
    anchor = r.integers(-3, 4, d).astype(float) * scale
    kind = hard_negatives.exact_type(rows, anchor[None])
    whole = [[int(x) for x in row] for row in rows]
    score = [sum(x * int(y) for x, y in zip(row, anchor)) for row in whole]
    if kind is object:
        rows, anchor = np.array(whole, object), np.array([int(x) for x in anchor], object)
    allowed = r.random(n) < 0.8
    windows = [(-10 * scale * scale, 8 * scale * scale), (0, 0), (5, 4)]
    got = hard_negatives.search(hard_negatives.sorted_lists(rows.astype(kind)), anchor.astype(kind), windows, 4, allowed)
    for (least, most), found in zip(windows, got):
        assert found == sorted(((score[i], i) for i in range(n) if allowed[i] and least <= score[i] <= most), key=lambda x: (-x[0], x[1]))[:4]


def brute_codes(rows, dims=8, parts=8, entries=16, rounds=6, scale=4096):
    rows = sorted(((i, [math.floor(scale * x) for x in v], y) for i, v, y in usable(rows, dims)), key=lambda r: (*by_id(r), r[1]))
    fill = -dims % parts
    cut = [[tuple((v + [0] * fill)[p * (dims + fill) // parts:(p + 1) * (dims + fill) // parts]) for p in range(parts)] for _, v, _ in rows]
    books = [[cut[e][p] for e in range(min(entries, len(rows)))] for p in range(parts)]

    def assign(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            member = {}
            for c in cut:
                member.setdefault(assign(p, c[p])[1], []).append(c[p])
            for k, vs in member.items():
                new[p][k] = tuple(sum(x) // len(vs) for x in zip(*vs))
        books = new
    out, per_label = [], {}
    for (i, _, y), c in zip(rows, cut):
        best = [assign(p, c[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        per_label[y] = per_label.get(y, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in best), error, y))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, per_label[y], digest) for i, c, e, y in out), key=str)


@pytest.mark.parametrize("dims", [8, 19])
def test_codes_against_brute_force(spark, dims):
    rows = edge_vectors(dims)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({k: F.lit(v) for k, v in CLASH.items()})
    got = code_cells.compress(df)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(rows, dims)


def test_codes_of_small_and_empty_tables(spark):
    assert code_cells.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert code_cells.compress(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).count() == 0
    few = [(3, [0.5] * 8, None), (1, [0.25] * 8, None), (2, [3e6] * 8, 1)]  # the last one beyond 64-bit squares
    got = code_cells.compress(spark.createDataFrame(few, SCHEMA), rounds=1)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(few, rounds=1)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 30), st.sampled_from([2, 40, 5000]))
def test_cells_keep_every_entry_that_can_be_nearest(seed, spread):
    r = np.random.default_rng(seed)
    width = int(r.integers(1, 9))
    memo = code_cells.Memo(r.integers(-spread, spread, (16, width)))
    for _ in range(3):  # later batches meet cells of earlier ones
        points = r.integers(-2 * spread, 2 * spread, (200, width))
        distance = ((points[:, None, :] - memo.entries) ** 2).sum(2)
        entry, least = memo.nearest(points)
        assert (entry == distance.argmin(1)).all() and (least == distance.min(1)).all()


def test_cells_leave_dominated_entries_out_and_survive_shared_hashes(monkeypatch):
    r = np.random.default_rng(0)
    memo = code_cells.Memo(np.sort(r.integers(-4000, 4000, (16, 2)), axis=0))
    points = r.integers(-4000, 4000, (5000, 2))
    assert memo.entries_for(points).mean() < 0.5
    full = ((points[:, None, :] - memo.entries) ** 2).sum(2)
    monkeypatch.setattr(code_cells, "mix", lambda x: x % np.uint64(3))
    crowded = code_cells.Memo(memo.entries)
    for _ in range(2):
        entry, least = crowded.nearest(points)
        assert (entry == full.argmin(1)).all() and (least == full.min(1)).all()
    monkeypatch.setattr(code_cells, "MEMO_CELLS", 2)
    entry, least = code_cells.Memo(memo.entries).nearest(points)
    assert (entry == full.argmin(1)).all() and (least == full.min(1)).all()


def brute_nearest(rows, query, k=5):
    """{query place: [(score, id)]}; rows are (id, vector)."""
    x = np.array([v for _, v in rows], np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for a in (a for a, (i, _) in enumerate(rows) if query(i)):
        s = (x * x[a]).sum(1)
        order = sorted((b for b in range(len(rows)) if b != a), key=lambda b: (-round(s[b], 12), *by_id(rows[b])))[:k]
        out[a] = [(s[b], rows[b][0]) for b in order]
    return out


def recall_of(got, want):
    """got: rows of the query; want: of unique ids."""
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = [len(found.get(q, set()) & {i for _, i in near}) / max(len(near), 1) for q, near in want.items()]
    return sum(hits) / len(hits)


@pytest.mark.parametrize("cells, blocks", [(1 << 14, 1 << 11), (13, 3)])
def test_neighbours_with_ties_copies_and_unusable_rows(spark, cells, blocks):
    rows = edge_vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({k: F.lit(v) for k, v in CLASH.items()})
    got = learned_partitions.nearest(df, every(20), recall=1.0, cell_rows=cells, block_rows=blocks)
    assert got.columns == ["query_id", "rank", "vec_id", "score", "probes"]
    kept = [(i, v) for i, v, _ in usable(rows) if any(v)]
    whole = learned_partitions.nearest(df, every(20), recall=2.0, cell_rows=cells, block_rows=blocks).collect()  # visits every partition
    want = sorted(((kept[a][0], n + 1, i, round(s, 9)) for a, near in brute_nearest(kept, lambda i: i is not None and i % 20 == 0).items()
                   for n, (s, i) in enumerate(near)), key=str)
    assert sorted(((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in whole), key=str) == want
    assert got.count() == len(want)
    assert learned_partitions.nearest(df.limit(0), every(20)).count() == 0
    two = spark.createDataFrame([(20, [1e200, 0.0], 1), (3, [1e200, 1e200], 1), (4, [0.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    assert [(r.query_id, r.vec_id, round(r.score, 6)) for r in learned_partitions.nearest(two, every(20)).collect()] == [(20, 3, 0.707107)]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_neighbours_recall_on_the_tables(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    want = {rows[a][0]: near for a, near in brute_nearest(rows, lambda i: i % 50 == 0).items()}
    got = Q.op13_nearest_neighbours(spark, path).collect()
    assert len(got) == 5 * len(want) and recall_of(got, want) >= 0.9
    exact = {(q, i): s for q, near in want.items() for s, i in near}
    assert all(abs(exact[r.query_id, r.vec_id] - r.score) < 1e-9 for r in got if (r.query_id, r.vec_id) in exact)


def test_structured_vectors_need_few_partitions():
    r = np.random.default_rng(5)
    centres = r.standard_normal((60, 32))
    x = learned_partitions.unit(centres[r.integers(0, 60, 3000)] + 0.2 * r.standard_normal((3000, 32)))
    router = learned_partitions.fit(x)
    part = router.ranked(x)[:, 0]
    assert len(router.b2) == 16 and router.probes <= 3
    assert np.bincount(part, minlength=16).max() < 3 * 3000 / 16
    near = learned_partitions.neighbours(x, 10)
    graph = learned_partitions.balanced_parts(x, near, 16)
    assert set(np.bincount(graph)) <= {187, 188}
    assert (graph[near] == graph[:, None]).mean() > 0.6  # links within a part; 1/16 by chance


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_vector_codes"])
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_oracles(spark, name, sf):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '/root/testdata/{sf}/embeddings.parquet'")
    want = con.execute(Q.ORACLE[name])
    names = [c[0] for c in want.description]
    got = Q.QUERIES[name](spark, f"/root/testdata/{sf}").select(*names).collect()
    assert got and sorted(tuple(r) for r in got) == sorted(want.fetchall())
