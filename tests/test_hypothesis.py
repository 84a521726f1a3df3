"""Generated inputs: the distributed operators must equal brute force on any data."""

import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapse.operators import band_self_pairs, rank_desc

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(-20, 20)),
                          st.integers(0, 12)), min_size=0, max_size=40)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=ROWS, width=st.integers(0, 6), extra=st.integers(0, 4), rpt=st.sampled_from([2, 4096]))
def test_band_pairs_equal_brute_force(spark, rows, width, extra, rpt):
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, blk string, v int, w int")
    got = band_self_pairs(df, "id", ["blk"], "v", width, [], extra_bands=[("w", extra)], rows_per_task=rpt)
    pairs = [(r["id_a"], r["id_b"]) for r in got.collect()]
    want = {(a[0], b[0]) for a, b in itertools.combinations(data, 2)
            if a[1] == b[1] and a[2] is not None and b[2] is not None
            and abs(a[2] - b[2]) <= width and abs(a[3] - b[3]) <= extra}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


@SETTINGS
@given(rows=ROWS, buckets=st.integers(1, 9))
def test_rank_equals_window_rank(spark, rows, buckets):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, g string, v int, w int")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first())))
    got = rank_desc(df, ["g"], "v", "r", buckets=buckets, materialize=False)
    assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(map(tuple, want.select("id", "r").collect()))
