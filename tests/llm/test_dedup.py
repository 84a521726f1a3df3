"""Exact and near deduplication and repeated passages against brute-force versions."""

import hashlib
from collections import Counter

import brute
import edge_cases
import pytest
from pyspark.sql import functions as F

from lapse.llm import exact_dedup, near_dedup, repeated_passages

ROWS = edge_cases.edge_rows()


def exact_brute(rows, pick):
    norm = [(d, (t or "").translate(brute.LOWER)) for d, t, *_ in rows]
    size = Counter(n for _, n in norm)
    keep = {}
    for d, n in norm:
        if d is not None:
            keep[n] = d if n not in keep else pick(keep[n], d)
    return sorted(((d, keep.get(n), size[n], hashlib.sha256(n.encode()).hexdigest()) for d, n in norm), key=str)


@pytest.mark.parametrize("keep,pick", [("smallest", min), ("largest", max)])
@pytest.mark.parametrize("table", ["edge", "clashing"])
def test_exact_groups(request, table, keep, pick):
    got = exact_dedup.group_copies(request.getfixturevalue(table), keep=keep).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == exact_brute(ROWS, pick)
    texts = {(t or "").translate(brute.LOWER) for _, t, *_ in ROWS}
    assert sum(r.kept for r in got) == len(texts)


def test_exact_hash_collisions_are_told_apart(edge):
    weak = exact_dedup.group_copies(edge, digest=lambda c: F.lit("same"), keep="largest").collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in weak), key=str) == exact_brute(ROWS, max)


def test_exact_keep_one_returns_whole_rows(clashing, empty):
    got = exact_dedup.keep_one(clashing)
    assert got.columns == clashing.columns
    assert got.count() == len({(t or "").translate(brute.LOWER) for _, t, *_ in ROWS})
    assert exact_dedup.keep_one(empty).count() == exact_dedup.group_copies(empty).count() == 0


def test_near_duplicates_on_edge_cases(edge, clashing, empty):
    ids = [(n, t) for n, (_, t, *_) in enumerate(ROWS)]
    want = brute.near_duplicates(ids)
    numbered = edge.sparkSession.createDataFrame([(n, t) for n, t in ids], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(numbered).collect()}
    assert got == want
    kept = near_dedup.near_duplicates(clashing).where("kept").count()
    assert kept == near_dedup.near_duplicates(edge).where("kept").count()
    assert near_dedup.near_duplicates(edge).count() == len(ROWS)
    assert near_dedup.near_duplicates(empty).count() == near_dedup.keep_one(empty).count() == 0
    assert near_dedup.keep_one(clashing).columns == clashing.columns


def test_near_duplicates_of_a_large_group_and_a_chain(spark):
    base = edge_cases.prose(7, 120).split()
    rows, at = [], 0
    for i in range(150):  # each differs from the first at one place of its own
        w = base.copy()
        w[i % 120] = f"new{i}"
        rows.append((at, " ".join(w)))
        at += 1
    chain = edge_cases.prose(8, 400).split()
    for i in range(40):  # a window that slides: neighbours are linked, the ends are not
        rows.append((at, " ".join(chain[4 * i:4 * i + 60])))
        at += 1
    for i in range(200):  # a shared line in otherwise different short texts
        rows.append((at, "a common line that many short texts share " + edge_cases.prose(1000 + i, 3)))
        at += 1
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(rows)


def test_near_duplicates_when_every_key_has_many_parts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CELL_ROWS", 2)
    rows = [(i, " ".join(edge_cases.prose(i // 6, 90).split()[i % 6:])) for i in range(90)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(rows)


def test_sketch_estimates_are_close():
    import numpy as np
    import pyarrow as pa

    from lapse.llm.wordarrays import split_words

    base = edge_cases.prose(9, 4000).split()
    other = base.copy()
    for i in range(0, 4000, 60):
        other[i] = f"x{i}"
    texts = [" ".join(base), " ".join(other)]
    text, code, _ = near_dedup.shingle_sets(split_words(pa.array(texts), lower=True))
    sketch = near_dedup.sketches(text, code, 2)
    a, b = (brute.shingles(t) for t in texts)
    near, used = near_dedup.estimate(sketch[:1], sketch[1:])
    assert used[0] == near_dedup.REGISTERS and abs(near[0] - len(a & b) / len(a | b)) < 0.12
    assert np.all(near_dedup.estimate(sketch[:1], sketch[:1])[0] > 0.99)


@pytest.mark.parametrize("table", ["edge", "clashing"])
def test_repeats_on_edge_cases(request, table):
    got = repeated_passages.remove_repeats(request.getfixturevalue(table)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.remove_repeats([r[:2] for r in ROWS])))


def test_repeats_of_partial_and_overlapping_passages(spark, empty):
    p = edge_cases.prose(20, 200).split()
    rows = [
        (1, " ".join(p)), (2, edge_cases.prose(21, 50) + " " + " ".join(p[20:90])), (3, " ".join(p[60:130]) + " " + edge_cases.prose(22, 9)),
        (4, " ".join(p[100:134])), (5, " ".join(p[100:135])), (6, " ".join(p[:40] + p[:40])), (7, "a b " * 60), (8, edge_cases.prose(23, 40)),
        (9, " ".join(p[150:]) + "\n\n" + " ".join(p[150:])), (10, edge_cases.prose(24, 30) + "\t" + " ".join(p[20:90]) + "\r" + edge_cases.prose(25, 34)),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeated_passages.remove_repeats(df).collect()
    assert sorted(map(tuple, got)) == sorted(brute.remove_repeats(rows))
    assert repeated_passages.remove_repeats(empty).count() == 0


def test_repeats_in_long_segments(spark, monkeypatch):
    monkeypatch.setattr(repeated_passages, "SEGMENT_WINDOWS", 50)
    monkeypatch.setattr(repeated_passages, "BATCH_BYTES", 500)
    p = edge_cases.prose(30, 500).split()
    rows = [(1, " ".join(p)), (2, "x " + " ".join(p[7:])), (3, " ".join(p[:230]) + " y " + " ".join(p[231:]))]
    got = repeated_passages.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute.remove_repeats(rows))


def test_null_ids_are_rows_of_their_own(spark):
    texts = [edge_cases.prose(40 + i, 60) for i in range(4)]
    near = texts[0].split()
    near[30] = "other"
    rows = [(None, t) for t in texts] + [(None, " ".join(near)), (None, texts[1]), (5, texts[2]), (None, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in near_dedup.keep_one(df).collect()]
    assert sorted(map(str, kept)) in [sorted(map(str, [(None, first), (None, texts[1]), (5, texts[2]), (None, texts[3]), (None, ""), (None, None)]))
                                      for first in (texts[0], " ".join(near))]
    assert exact_dedup.keep_one(df).count() == 6  # five texts and the empty one
