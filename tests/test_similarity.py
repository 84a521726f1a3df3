"""Similarity join on edit distance, grid joins and bit sets against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from lapse.operators.bitsets import bitsets, dense_numbers, shared_values
from lapse.operators.edit_join import remainders, similar_texts
from lapse.operators.grid import deal, grid_join
from lapse.plans import relational as R


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def texts(seed, n, alphabet="abcd é中"):
    r = random.Random(seed)
    base = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 20))) for _ in range(n // 6)]

    def changed(t):
        t = list(t)
        for _ in range(r.randint(0, 4)):
            at = r.randint(0, len(t))
            t[at:at + r.randint(0, 1)] = [r.choice(alphabet)] * r.randint(0, 1)
        return "".join(t)

    return [changed(r.choice(base)) for _ in range(n)] + ["", "a", "ab", None, "a" * 40, "a" * 42, "b" + "a" * 40]


@pytest.mark.parametrize("k, q, rows", [(3, 2, 4096), (3, 3, 5), (1, 2, 7), (0, 2, 4096)])
def test_similar_texts_against_all_pairs(spark, k, q, rows):
    ts = texts(k * 10 + q, 260)
    got = similar_texts(spark.createDataFrame([(t,) for t in ts], "t string"), "t", k, q, rows).collect()
    kept = sorted({t for t in ts if t is not None}, key=lambda t: t.encode())
    want = {(a, b): d for i, a in enumerate(kept) for b in kept[i + 1:] if (d := edits(a, b)) <= k}
    assert len(got) == len(want) and {(r.text_a, r.text_b): r.distance for r in got} == want


def test_similar_texts_that_share_all_their_grams(spark):
    """Every text has the same frequent grams, the rare ones decide."""
    ts = [f"customer number {i:04d} of the northern region" for i in range(0, 600, 7)]
    got = similar_texts(spark.createDataFrame([(t,) for t in ts], "t string"), "t", 1, 2, 16).collect()
    assert {(r.text_a, r.text_b) for r in got} == {(a, b) for a in ts for b in ts if a < b and edits(a, b) <= 1}
    assert similar_texts(spark.createDataFrame([], "t string"), "t").count() == 0


def test_remainders(spark):
    left = spark.createDataFrame([("aba",)], "t string").select(remainders(F.col("t"), 2).alias("x")).first()["x"]
    assert sorted(left) == ["a", "aa", "ab", "aba", "b", "ba"]


def test_names_and_the_strict_rule(spark):
    rows = [(1, "Acme Labs ", "a@x.com"), (2, "acme  labz", "b@y.com"), (3, "AcmeLabs", "c@x.com"), (4, "acme labs", "d@z.com"),
            (5, "acme laboratories", "e@x.com"), (6, None, "f@x.com"), (7, " ", "g@x.com")]
    e = spark.createDataFrame(rows, "customer_id int, company_name string, contact_email string").withColumn("signup_date", F.to_date(F.lit("2024-01-01")))
    got = {(r.name_a, r.name_b): (r.distance, r.same_first_word, r.accounts_a, r.accounts_b) for r in R.similar_names(e).collect()}
    assert got == {("acme labs", "acme labz"): (1, True, 2, 1), ("acme labs", "acmelabs"): (1, False, 2, 1), ("acme labz", "acmelabs"): (2, False, 1, 1)}
    strict = {(r.cust_a_id, r.cust_b_id): (r.similar_name, r.match_score) for r in R.duplicate_accounts(e, max_edits=3).collect()}
    assert strict == {(1, 2): (1, 2), (1, 3): (0, 2), (1, 4): (1, 2), (1, 5): (0, 2), (2, 4): (1, 2), (3, 5): (0, 2)}


def test_grid_cells_stay_small_whichever_side_is_hot(spark):
    left = spark.createDataFrame([("hot", i) for i in range(3)] + [("cold", i) for i in range(900)], "k string, l int")
    right = spark.range(100_000).select(F.lit("hot").alias("k"), F.col("id").alias("r")).union(
        spark.range(5).select(F.lit("cold"), F.col("id")))
    a, b = deal(left, right, ["k"], F.col("l"), F.col("r"), 256)
    for side in (a, b):
        assert side.groupBy("k", "_line", "_column").count().agg(F.max("count")).first()[0] < 2 * 256
    j = grid_join(left, right, ["k"], F.col("l"), F.col("r"), 256)
    assert j.count() == j.distinct().count() == 3 * 100_000 + 900 * 5


def test_shared_values_of_bitsets(spark):
    r = random.Random(4)
    sets = {k: {r.choice(range(12)) if r.random() < 0.5 else r.randint(0, 400) for _ in range(r.randint(0, 40))} for k in range(60)}
    df = spark.createDataFrame([(k, f"v{v}") for k, vs in sets.items() for v in vs] + [(0, None)], "k int, v string")
    numbers = dense_numbers(df, "v", "n").collect()
    assert sorted(x.n for x in numbers) == list(range(len({v for vs in sets.values() for v in vs})))
    held = {}
    for vs in sets.values():
        for v in vs:
            held[f"v{v}"] = held.get(f"v{v}", 0) + 1
    assert min(held[x.v] for x in numbers if x.n < 64) >= max(held[x.v] for x in numbers if x.n >= 64)
    b = bitsets(df.join(dense_numbers(df, "v", "n"), "v"), ["k"], "n", "s")
    one, two = b.toDF("k1", "s1", "m1"), b.toDF("k2", "s2", "m2")
    got = one.crossJoin(two).select("k1", "k2", shared_values(("s1", "m1"), ("s2", "m2")).alias("n")).collect()
    assert {(x.k1, x.k2): x.n for x in got} == {(a, c): len(sets[a] & sets[c]) for a in sets for c in sets if sets[a] and sets[c]}
