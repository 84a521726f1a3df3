import datetime as dt

from pyspark.sql import functions as F

from lapse.functions import (email_domain, first_token, normalize_name, norm_cdf, parse_mixed_timestamp,
                             safe_bigint, strip_subaddress, chi2_sf_df1, iso_week_key)


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("x")).alias("r")).first()["r"]


def test_subaddress_first_match_only(spark):
    assert one(spark, strip_subaddress, "a+b@c+d.com") == "a@c+d.com"
    assert one(spark, strip_subaddress, "a+@b+c.com") == "a+@b"  # first '+' followed by a non-'@'
    assert one(spark, email_domain, "U1+Work@Acme.COM") == "acme.com"


def test_email_without_at_and_null(spark):
    assert one(spark, email_domain, "nobody") == ""
    assert one(spark, email_domain, None) is None


def test_name_normalisation(spark):
    assert one(spark, normalize_name, "  Acme \t  Labs ") == "acme labs"
    assert one(spark, first_token, "acme labs") == "acme"
    assert one(spark, first_token, "") == ""


def test_safe_bigint(spark):
    df = spark.createDataFrame([("12",), ("12.0",), ("12.5",), ("x",), (" 7 ",), (None,), ("-3",)], "x string")
    got = [r[0] for r in df.select(safe_bigint("x")).collect()]
    assert got == [12, 12, None, None, 7, None, -3]


def test_mixed_timestamps(spark):
    rows = ["2024-01-05T10:11:12Z", "2024-01-05 10:11:12", "01/05/2024 10:11:12",
            "2024-01-05T12:11:12.250000+02:00", "2024-01-05T10:11:12.5+0000", "junk", None]
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    got = [r[0] for r in df.select(parse_mixed_timestamp("x")).collect()]
    base = dt.datetime(2024, 1, 5, 10, 11, 12)
    assert got == [base, base, base, base.replace(microsecond=250000), base.replace(microsecond=500000), None, None]


def test_mixed_timestamps_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        test_mixed_timestamps(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_iso_week_key(spark):
    assert one(spark, iso_week_key, dt.date(2024, 12, 30), "x date") == "2025-W1"
    assert one(spark, iso_week_key, dt.date(2024, 1, 7), "x date") == "2024-W1"


def test_norm_cdf_and_chi2_tail(spark):
    df = spark.createDataFrame([(0.0,), (1.959963985,), (-1.0,)], "x double")
    got = [r[0] for r in df.select(norm_cdf(F.col("x"))).collect()]
    assert abs(got[0] - 0.5) < 1e-7 and abs(got[1] - 0.975) < 2e-7 and abs(got[2] - 0.1586553) < 2e-7
    p = spark.createDataFrame([(3.841458821,)], "x double").select(chi2_sf_df1(F.col("x"))).first()[0]
    assert abs(p - 0.05) < 2e-7


def test_half_even_vs_half_up(spark):
    r = spark.range(1).select(F.bround(F.lit(2.5), 0).alias("e"), F.round(F.lit(2.5), 0).alias("u")).first()
    assert (r["e"], r["u"]) == (2.0, 3.0)


def test_tails_keep_their_relative_accuracy(spark):
    import math

    from lapse.functions.stats import erf, erfc
    xs = [i / 100 for i in range(-400, 801)] + [10.0, 20.0, 26.0, None]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", erfc(F.col("x")).alias("c"), erf(F.col("x")).alias("e")).collect()
    assert got[-1].c is None and got[-1].e is None
    for r in got[:-1]:
        assert abs(r.c / math.erfc(r.x) - 1) < 1e-12 and abs(r.e - math.erf(r.x)) < 1e-14
    z = spark.createDataFrame([(-8.0,), (-37.0,)], "x double").select(norm_cdf(F.col("x")).alias("p")).collect()
    assert all(abs(r.p / (math.erfc(-x / math.sqrt(2)) / 2) - 1) < 1e-12 for r, x in zip(z, (8.0 * -1, -37.0)))
    p = spark.createDataFrame([(130.0,)], "x double").select(chi2_sf_df1(F.col("x")).alias("p")).first().p
    assert abs(p / math.erfc(math.sqrt(65.0)) - 1) < 1e-12
