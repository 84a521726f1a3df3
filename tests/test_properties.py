"""Property checks on the real (smallest) tables."""

import pytest
from pyspark.sql import functions as F

from lapse.plans import analysis as A
from lapse.plans import events as E
from lapse.plans import relational as R
from lapse.sources import Domain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def dom(spark):
    return Domain(spark, SF)


def test_winsorized_max_is_the_cap(dom):
    base = A.fill_defaults(A.customer_base(dom.customers, dom.latest_subscription, dom.plans, dom.support_tickets))
    capped, cap, audit = A.winsorize_upper(base, "mrr_usd", 0.99)
    assert capped.agg(F.max("mrr_usd")).first()[0] <= cap
    assert audit.first()["outliers"] == base.where(F.col("mrr_usd") > cap).count()
    assert capped.count() == base.count()          # capping never drops rows


def test_rank_starts_at_one_in_every_tier(dom):
    r = R.ltv_rank(dom.customers, dom.latest_subscription, dom.plans, dom.billing_invoices, ordered=False)
    per_tier = r.groupBy("plan_tier").agg(F.min("tier_rank").alias("lo"), F.max("tier_rank").alias("hi"),
                                          F.count(F.lit(1)).alias("n")).collect()
    assert per_tier and all(t["lo"] == 1 and t["hi"] <= t["n"] for t in per_tier)


def test_funnel_counts_bounded_by_users(dom):
    c = E.funnel_counts(dom.onboarding_events).first()
    assert all(0 <= c[s] <= c["total_users"] for s in E.FUNNEL_STEPS)


def test_semi_plus_anti_is_everything(dom):
    ev = E.normalize_events(dom.raw_activity_logs)
    kept = E.drop_orphans(ev, dom.customers).count()
    orphans = ev.join(dom.customers.select("customer_id"), "customer_id", "left_anti").count()
    assert kept + orphans == ev.count() and orphans > 0


def test_duplicate_pairs_are_ordered_and_unique(dom):
    p = R.duplicate_accounts(dom.duplicate_entities, ordered=False)
    assert p.where(F.col("cust_a_id") >= F.col("cust_b_id")).count() == 0
    assert p.count() == p.select("cust_a_id", "cust_b_id").distinct().count()
    assert p.where(F.col("match_score") < 2).count() == 0
