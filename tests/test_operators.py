import itertools
import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapse.operators import band_self_pairs, exact_quantile, floor_index_quantiles, latest_per, rank_desc
from lapse.operators import order_stats


def test_latest_per_tie_break_and_nulls_first(spark):
    df = spark.createDataFrame(
        [(1, 10, "2024-01-01", "a"), (1, 11, "2024-01-01", "b"), (1, 9, "2023-01-01", "c"),
         (2, 20, None, "d"), (2, 21, "2024-05-01", "e")], "k int, sid int, d string, v string")
    got = {r["k"]: r["v"] for r in latest_per(df, ["k"], ["d", "sid"]).collect()}
    assert got == {1: "b", 2: "d"}  # same date -> higher id; NULL date counts as latest (DESC NULLS FIRST)


def test_rank_desc_matches_window_rank(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["a", "b", None]), rnd.randint(0, 30)) for _ in range(400)] + [("a", None), (None, None)]
    df = spark.createDataFrame(rows, "g string, v int")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first())))
    for buckets in (1, 3, 16):
        got = rank_desc(df, ["g"], "v", "r", buckets=buckets)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_band_self_pairs_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["x", "y"]), rnd.choice([None] + list(range(40)))) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, blk string, v int")
    got = {(r["id_a"], r["id_b"]) for r in band_self_pairs(df, "id", ["blk"], "v", 7, ["v"]).collect()}
    want = {(a[0], b[0]) for a, b in itertools.combinations(sorted(rows), 2)
            if a[1] == b[1] and a[2] is not None and b[2] is not None and abs(a[2] - b[2]) <= 7}
    assert got == want


def test_band_self_pairs_few_values_use_all_partitions(spark):
    df = spark.range(900).selectExpr("id", "concat('d', id % 9) as blk", "int(id % 23) as v", "if(id % 50 = 0, null, id) as own_id")
    got = band_self_pairs(df, "own_id", ["blk"], "v", 7, [], own=["id"], where=lambda a, b: a("v") != b("v"),
                          shared=lambda a, b: {"gap": F.abs(a("v") - b("v"))}).withColumn("task", F.spark_partition_id()).collect()
    rows = [(i, i % 9, i % 23) for i in range(900) if i % 50]
    want = {(a[0], b[0], a[0], b[0], abs(a[2] - b[2])) for a, b in itertools.combinations(rows, 2) if a[1] == b[1] and 0 < abs(a[2] - b[2]) <= 7}
    assert len(got) == len(want) and {(r.own_id_a, r.own_id_b, r.id_a, r.id_b, r.gap) for r in got} == want
    # the pairs are made by as many tasks as the session has shuffle partitions, however few bytes the rows have
    plain = band_self_pairs(df, "id", ["blk"], "v", 7, [])
    assert plain.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_band_self_pairs_lists_are_short_and_whole(spark):
    from lapse.operators.pairs import LIST, listed
    df = spark.range(1000).selectExpr("id", "if(id < 900, 'hot', concat('c', id % 40)) as blk")
    lists = [(r.blk, r._rows) for r in listed(df, ["blk"], "id", F.col("id")).collect()]
    assert sorted(i for _, rows in lists for i in rows) == list(range(1000))
    # no longer than LIST, and as few as that allows, so that a class is not taken apart by the cells that it goes to
    assert max(len(rows) for _, rows in lists) <= LIST and len(lists) == -(-900 // LIST) + 40
    got = band_self_pairs(df.withColumn("v", F.lit(3)), "id", ["blk"], "v", 7, [], rows_per_task=100)
    assert got.count() == got.distinct().count() == 900 * 899 // 2 + 20 * 1 + 20 * 3


def test_floor_index_quantiles(spark):
    df = spark.createDataFrame([("u", 3.0), ("u", 1.0), ("u", 2.0), ("w", 5.0), ("z", None)], "k string, v double")
    got = {r["k"]: (r["p25"], r["p50"], r["p75"]) for r in
           floor_index_quantiles(df, ["k"], "v", {"p25": .25, "p50": .5, "p75": .75}).collect()}
    assert got == {"u": (1.0, 2.0, 2.0), "w": (5.0, 5.0, 5.0)}  # [1,2,3] at .75 -> index 1 -> 2; z has none


def test_floor_index_quantiles_with_duplicates(spark):
    vals = [4, 4, 4, 1, 9, 9, 2, 7]
    df = spark.createDataFrame([("u", float(v)) for v in vals], "k string, v double")
    r = floor_index_quantiles(df, ["k"], "v", {"q": .75}).first()
    s = sorted(vals)
    assert r["q"] == s[int(np.floor(.75 * (len(s) - 1)))]


def test_exact_quantile_matches_numpy(spark, monkeypatch):
    rnd = np.random.default_rng(1)
    vals = np.concatenate([rnd.exponential(100, 3000), np.full(500, 42.0)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    for q in (0.0, 0.5, 0.99, 1.0):
        assert abs(exact_quantile(df, "x", q) - np.quantile(vals, q)) < 1e-9
    monkeypatch.setattr(order_stats, "ACCURACY", 50)  # several rounds of bracketing
    for q in (0.25, 0.99):
        assert abs(exact_quantile(df, "x", q) - np.quantile(vals, q)) < 1e-9


def test_chunked_lag_matches_window_lag(spark):
    from lapse.operators import chunked_lag
    import datetime as dt
    rnd = random.Random(11)
    base = dt.date(2020, 1, 1)
    rows = [(rnd.choice([1, 1, 1, 2, 3]), i, rnd.choice([None] + [base + dt.timedelta(days=rnd.randint(0, 90))] * 9),
             rnd.randint(1, 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, sid int, d date, p int")
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_last(), F.col("sid").asc_nulls_last())
    want = sorted(df.select("sid", F.lag("p").over(w).alias("prev_p")).collect())
    for buckets in (1, 4, 16):
        got = sorted(chunked_lag(df, ["k"], ["d", "sid"], ["p"], buckets=buckets).select("sid", "prev_p").collect())
        assert got == want


def test_prefix_counts_positions(spark):
    from lapse.operators import prefix_counts
    rows = [("g", v, c) for v, c in ((5, 2), (1, 1), (3, 4), (None, 2))]
    vc = spark.createDataFrame(rows, "g string, v int, _c long")
    asc = {r["v"]: (r["_before"], r["_n"]) for r in prefix_counts(vc, ["g"], "v", buckets=3).collect()}
    assert asc == {1: (0, 9), 3: (1, 9), 5: (5, 9), None: (7, 9)}
    desc = {r["v"]: r["_before"] for r in prefix_counts(vc, ["g"], "v", descending=True, buckets=3).collect()}
    assert desc == {None: 0, 5: 2, 3: 4, 1: 8}


def test_band_self_pairs_salted_hot_key(spark):
    rnd = random.Random(5)
    rows = [(i, "hot" if i % 3 else rnd.choice(["x", "y"]), rnd.randint(0, 30)) for i in range(150)]
    df = spark.createDataFrame(rows, "id int, blk string, v int")
    got = band_self_pairs(df, "id", ["blk"], "v", 7, ["v"], rows_per_task=5).collect()
    pairs = [(r["id_a"], r["id_b"]) for r in got]
    want = {(a[0], b[0]) for a, b in itertools.combinations(sorted(rows), 2)
            if a[1] == b[1] and abs(a[2] - b[2]) <= 7}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_band_self_pairs_extra_band(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.choice(["x", "y"]), rnd.randint(0, 40), rnd.randint(3, 30)) for i in range(160)]
    df = spark.createDataFrame(rows, "id int, blk string, v int, w int")
    for rpt in (4096, 7):
        got = band_self_pairs(df, "id", ["blk"], "v", 7, [], extra_bands=[("w", 5)], rows_per_task=rpt).collect()
        pairs = [(r["id_a"], r["id_b"]) for r in got]
        want = {(a[0], b[0]) for a, b in itertools.combinations(sorted(rows), 2)
                if a[1] == b[1] and abs(a[2] - b[2]) <= 7 and abs(a[3] - b[3]) <= 5}
        assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_interval_join_time_buckets_match_plain(spark):
    import datetime as dt
    from lapse.operators import interval_join
    rnd = random.Random(21)
    base = dt.datetime(2020, 1, 1)
    wins = spark.createDataFrame([(i, rnd.randint(1, 3), (base + dt.timedelta(days=rnd.randint(0, 120))).date())
                                  for i in range(60)], "wid int, k int, d date")
    evs = spark.createDataFrame([(j, rnd.randint(1, 3), base + dt.timedelta(hours=rnd.randint(0, 24 * 130)))
                                 for j in range(400)], "eid int, k int, t timestamp_ntz")
    day0 = F.col("w.d").cast("timestamp_ntz")
    lo, hi = day0 - F.make_dt_interval(F.lit(30)), day0
    plain = interval_join(wins, evs, ["k"], "t", lower=lo, upper=hi)
    bucketed = interval_join(wins, evs, ["k"], "t", lower=lo, upper=hi, bucket_days=30)
    a = sorted(map(tuple, plain.select("wid", "eid").collect()))
    b = sorted(map(tuple, bucketed.select("wid", "eid").collect()))
    assert a == b and len(a) > 0


def test_grouped_quantiles_of_all_groups_at_once(spark, monkeypatch):
    from lapse.operators import grouped_quantiles
    rnd = np.random.default_rng(4)
    groups = {"hot": np.concatenate([rnd.exponential(100, 4000), np.full(900, 42.0)]), "one": np.array([3.0]),
              "two": np.array([1.0, 2.0]), None: rnd.integers(-5, 5, 700).astype(float), "same": np.full(500, 7.0)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None), ("two", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    qs = {"lo": 0.0, "q1": 0.1, "mid": 0.5, "q99": 0.99, "hi": 1.0}
    for accuracy in (order_stats.ACCURACY, 100):
        monkeypatch.setattr(order_stats, "ACCURACY", accuracy)
        got = {r["g"]: r for r in grouped_quantiles(df, ["g"], "v", qs, count_col="n").collect()}
        assert set(got) == set(groups)
        for g, vs in groups.items():
            assert got[g]["n"] == len(vs)
            assert np.allclose([got[g][n] for n in qs], np.quantile(vs, list(qs.values())), rtol=0, atol=1e-9)
    assert grouped_quantiles(df.limit(0), [], "v", {"q": 0.5}).count() == 0


def test_packed_latest_equals_the_struct_one(spark):
    import datetime as dt
    rnd = random.Random(31)
    base = dt.date(1960, 1, 1)
    texts = [None, "", "a", "active", "14 bytes long!", "é中", "trailing\u0001"]
    rows = [(rnd.choice([None, 1, 2, 3]), i * rnd.choice([1, 2 ** 30]), rnd.choice([None] + [base + dt.timedelta(days=rnd.randint(0, 40000)) for _ in range(6)]),
             rnd.choice([None, 5, -7]), rnd.choice(texts), rnd.choice([None, 1.5, -2.25]), rnd.choice([None, True, False])) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, sid long, d date, p int, t string, x double, b boolean")
    plain, packed = (sorted(map(tuple, latest_per(df, ["k"], ["d", "sid"], packed=p).select(*df.columns).collect()), key=str) for p in (False, True))
    assert plain == packed
    narrow = latest_per(df, ["k"], ["d", "sid"], columns=["k", "t"], packed=True)
    assert narrow.columns == ["k", "t"] and latest_per(df.limit(0), ["k"], ["d", "sid"], packed=True).count() == 0


def test_packed_latest_raises_rather_than_misplace(spark):
    import pytest
    for sid, day, text in ((-1, "2020-01-01", "a"), (2 ** 46, "2020-01-01", "a"), (1, "2500-01-01", "a"), (1, "2020-01-01", "fifteen bytes !")):
        df = spark.createDataFrame([(1, sid, text)], "k int, sid long, t string").withColumn("d", F.to_date(F.lit(day)))
        with pytest.raises(Exception, match="outside the range of a packed order"):
            latest_per(df, ["k"], ["d", "sid"], packed=True).collect()
        assert latest_per(df, ["k"], ["d", "sid"]).count() == 1
