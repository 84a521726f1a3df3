"""Edge rules: large and text ids, empty inputs, zero margins, reference times, shared staging, big bucket lookups."""

import datetime as dt
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse import session
from lapse.functions.casting import safe_bigint
from lapse.functions.timeparse import as_datetime
from lapse.operators.pairs import band_self_pairs
from lapse.operators.prefix import bucket_of
from lapse.plans import analysis as A
from lapse.plans import events as E
from lapse.plans import relational as R


def test_large_and_double_ids_survive_the_cast(spark):
    df = spark.createDataFrame([(10_000_000.0, "1.0E7"), (12_345_678.0, "1.2345678E7"), (1.5, "1.5E0"), (3.0, " 3.0 ")], "d double, s string")
    got = df.select(safe_bigint("d", dtype=T.DoubleType()).alias("d"), safe_bigint("s").alias("s"), safe_bigint("d").alias("p")).collect()
    assert [tuple(r) for r in got] == [(10_000_000,) * 3, (12_345_678,) * 3, (None,) * 3, (3,) * 3]


def test_text_member_ids_are_kept_on_request(spark):
    raw = spark.createDataFrame([("m-1", 5.0, "2024-01-01 00:00:00"), ("7", 2.0e7, "2024-01-01 00:00:00"), (None, 1.0, "2024-01-01 00:00:00")],
                                "member_id string, customer_id double, timestamp string")
    got = {(r.member_key, r.member_id, r.customer_id) for r in E.normalize_events(raw, member_text=True).collect()}
    assert got == {("m-1", None, 5), ("7", 7, 20_000_000)}
    assert [r.member_id for r in E.normalize_events(raw).collect()] == [7]
    bad = raw.withColumn("customer_id", F.lit("x"))
    assert E.normalize_events(bad).count() == 0 and E.normalize_events(bad, need_customer=False).count() == 1


def test_empty_funnel_and_raw_step_times(spark):
    kind = "member_id long, step string, completed boolean, timestamp string"
    rows = E.onboarding_funnel(spark.createDataFrame([], kind)).collect()
    assert [r.users for r in rows] == [0] * 5
    done = spark.createDataFrame([(1, "signup", True, "01/05/2024 11:00:00"), (1, "first_login", True, "2024-01-05T11:00:30Z")], kind)
    assert E.step_gap_median(done).first().median_gap_sec == 30.0


def test_chi_square_with_an_empty_margin_and_p_before_rounding(spark):
    df = spark.createDataFrame([(True, False), (False, False)], "used_ai_suggest boolean, is_churned boolean")
    row = A.chi_square_2x2(df).first()
    assert row.chi2 is None and row.p_value is None
    assert A.two_proportion_ztest(df).first().z_stat is None
    capped, cap, audit = A.winsorize_upper(df.limit(0).withColumn("v", F.lit(1.0)), "v")
    assert cap is None and audit.columns == ["outliers", "cap"]


def test_reference_time_keeps_its_time_of_day(spark):
    plans = spark.createDataFrame([(1, "a", "x", 10), (2, "b", "y", 5)], "plan_id int, plan_name string, plan_tier string, monthly_price_usd int")
    subs = spark.createDataFrame([(1, 1, 1, dt.date(2001, 1, 1)), (2, 1, 2, dt.date(2001, 5, 3))],
                                 "subscription_id int, customer_id int, plan_id int, start_date date")
    assert R.downgrades(subs, plans, dt.datetime(2001, 8, 1), 90).count() == 1
    assert R.downgrades(subs, plans, dt.datetime(2001, 8, 1, 13), 90).count() == 0
    assert abs((as_datetime(None) - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 60


@pytest.mark.parametrize("n", [1, 2, 5, 63, 64, 65, 1023])
def test_two_level_bucket_lookup(spark, n):
    rnd = random.Random(n)
    bounds = sorted({round(rnd.uniform(0, 100), 3) for _ in range(n)})
    values = [rnd.uniform(-5, 105) for _ in range(60)] + bounds[:5] + [None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", bucket_of(F.col("v"), bounds).alias("b")).collect():
        assert r.b == (len(bounds) + 1 if r.v is None else sum(b < r.v for b in bounds))


def test_hot_band_keys_are_cut_into_cells(spark):
    df = spark.createDataFrame([(i, "hot", i % 9) for i in range(120)], "id int, k string, v int")
    want = {(a, b) for a in range(120) for b in range(a + 1, 120) if abs(a % 9 - b % 9) <= 3}
    for rows_per_task in (7, 4096):
        got = band_self_pairs(df, "id", ["k"], "v", 3, [], rows_per_task=rows_per_task).select("id_a", "id_b").collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_a_cluster_without_a_shared_folder_is_an_error():
    conf = SimpleNamespace(get=lambda *_: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))
