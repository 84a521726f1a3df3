"""Customer analysis frame and the statistics computed on it (P1-P7, P10).

The frame is one row per named customer; statistics reduce it to one-row
DataFrames with closed-form column expressions, so nothing but a handful of
counts ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import chi2_sf_df1, norm_cdf
from ..operators.order_stats import quantile

# Default fills and the exported column list.
CATEGORICAL_DEFAULTS = ("plan_tier", "industry", "company_size", "country_code")
UNKNOWN = "unknown"
EXPORT_COLUMNS = ("customer_id", "plan_tier", "is_churned", "mrr_usd", "signup_date", "ticket_count", "industry",
                  "company_size", "country_code", "used_ai_suggest", "ai_suggest_clicks", "total_feature_clicks",
                  "distinct_features_used", "total_session_sec", "months_since_signup", "segment", "segment_label")
ALPHA = 0.05
MIN_EXPECTED = 5


# --------------------------------------------------------------------------- P1
def named_customers(customers: DataFrame) -> DataFrame:
    """Customers with a name: the valid ids of the analysis."""
    return customers.where(F.col("company_name").isNotNull() & (F.trim(F.col("company_name")) != ""))


def customer_base(customers: DataFrame, latest_subscription: DataFrame, plans: DataFrame,
                  tickets: DataFrame) -> DataFrame:
    """Named customers with their latest subscription, its tier and distinct ticket count.

    Tickets are reduced to one count per customer before the join (instead of
    joining every ticket and grouping on fourteen columns).
    """
    named = named_customers(customers)
    sub = latest_subscription.select(
        "customer_id", "plan_id", "mrr_usd", F.col("status").alias("sub_status"),
        F.col("start_date").alias("sub_start"), F.col("end_date").alias("sub_end"))
    tiers = plans.select("plan_id", "plan_tier")
    tk = tickets.groupBy("customer_id").agg(F.count_distinct("ticket_id").alias("ticket_count"))
    return (named.join(sub, "customer_id", "left").join(tiers, "plan_id", "left").join(tk, "customer_id", "left")
            .select("customer_id", "company_name", "industry", "company_size", "country_code", "signup_date",
                    "is_active", "churned_at", "churn_reason", "plan_tier",
                    F.col("mrr_usd").cast("double").alias("mrr_usd"), "sub_status", "sub_start", "sub_end",
                    F.coalesce(F.col("ticket_count"), F.lit(0)).cast("bigint").alias("ticket_count"),
                    F.col("churned_at").isNotNull().alias("is_churned")))


# --------------------------------------------------------------------------- P3
def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: NULL count of every column, in one aggregation pass."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def dataset_profile(df: DataFrame, flags: Sequence[str] = ()) -> DataFrame:
    """One row: row count, column count and, per boolean flag, how many rows have it set."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"),
                  *[F.count_if(F.col(f)).alias(f"{f}_rows") for f in flags])


def fill_defaults(df: DataFrame) -> DataFrame:
    """Categoricals -> 'unknown', mrr -> 0, ticket_count -> 0 (as integer)."""
    out = df
    cats = [c for c in CATEGORICAL_DEFAULTS if c in df.columns]
    if cats:
        out = out.fillna(UNKNOWN, subset=cats)
    if "mrr_usd" in df.columns:
        out = out.withColumn("mrr_usd", F.coalesce(F.col("mrr_usd"), F.lit(0.0)))
    if "ticket_count" in df.columns:
        out = out.withColumn("ticket_count", F.coalesce(F.col("ticket_count"), F.lit(0)).cast("bigint"))
    return out


# --------------------------------------------------------------------------- P4
def cap_at_quantile(df: DataFrame, col: str, q: float = 0.99) -> tuple[DataFrame, DataFrame]:
    """(``df`` with ``col`` capped at its exact ``q`` quantile, one-row audit: outliers, cap).

    The cap is a scalar subquery of either plan (NULL where the column has no value): nothing runs here.
    """
    cap = quantile(df, col, q)
    with_cap = df.withColumn("_cap", cap)
    capped = with_cap.withColumn(col, F.least(F.col(col), F.col("_cap"))).drop("_cap")  # least() passes over NULL
    audit = with_cap.agg(F.count_if(F.col(col) > F.col("_cap")).alias("outliers")).withColumn("cap", cap)
    return capped, audit


def winsorize_upper(df: DataFrame, col: str, q: float = 0.99) -> tuple[DataFrame, float | None, DataFrame]:
    """``cap_at_quantile`` and the cap as a number, for which a job runs."""
    capped, audit = cap_at_quantile(df, col, q)
    return capped, audit.first()["cap"], audit


# --------------------------------------------------------------------------- P5
def engagement_features(base: DataFrame, logs: DataFrame, flag_feature: str) -> DataFrame:
    """Per customer: flag-feature clicks and use, total non-null feature events,
    distinct features, session seconds; customers without events get False / 0."""
    # one pass over the events: flag-feature clicks and the usage totals together
    usage = logs.groupBy("customer_id").agg(
        F.count_if(F.col("feature") == flag_feature).alias("ai_suggest_clicks"),
        F.count("feature").alias("total_feature_clicks"),
        F.count_distinct("feature").alias("distinct_features_used"),
        F.sum("session_duration_sec").alias("total_session_sec"))
    m = base.join(usage, "customer_id", "left")
    return m.select(
        *[c for c in base.columns],
        F.coalesce(F.col("ai_suggest_clicks") > 0, F.lit(False)).alias("used_ai_suggest"),
        F.coalesce(F.col("ai_suggest_clicks"), F.lit(0)).cast("bigint").alias("ai_suggest_clicks"),
        F.coalesce(F.col("total_feature_clicks"), F.lit(0)).cast("bigint").alias("total_feature_clicks"),
        F.coalesce(F.col("distinct_features_used"), F.lit(0)).cast("bigint").alias("distinct_features_used"),
        F.coalesce(F.col("total_session_sec"), F.lit(0.0)).cast("double").alias("total_session_sec"))


def months_since(df: DataFrame, ref_date: str = "2025-11-01", col: str = "signup_date") -> DataFrame:
    """(ref - date) in days / 30, NULL -> 0, floored at 0."""
    m = F.datediff(F.lit(ref_date).cast("date"), F.col(col)) / F.lit(30.0)
    return df.withColumn("months_since_signup", F.greatest(F.coalesce(m, F.lit(0.0)), F.lit(0.0)))


# --------------------------------------------------------------------------- P6 / P7
def contingency_2x2(df: DataFrame, group_flag: str, outcome: str) -> DataFrame:
    """One row: n1, x1 (flag true), n2, x2 (flag false); successes = outcome true."""
    g, y = F.col(group_flag), F.col(outcome)
    return df.agg(F.count_if(g).alias("n1"), F.count_if(g & y).alias("x1"),
                  F.count_if(~g).alias("n2"), F.count_if(~g & y).alias("x2"))


def two_proportion_ztest(df: DataFrame, group_flag: str = "used_ai_suggest", outcome: str = "is_churned",
                         alpha: float = ALPHA) -> DataFrame:
    """One-tailed (H1: p1 < p2) pooled two-proportion z-test as a one-row DataFrame."""
    t = contingency_2x2(df, group_flag, outcome)
    n1, n2, x1, x2 = (F.col(c).cast("double") for c in ("n1", "n2", "x1", "x2"))
    p1, p2 = F.try_divide(x1, n1), F.try_divide(x2, n2)
    pool = F.try_divide(x1 + x2, n1 + n2)
    se = F.sqrt(pool * (F.lit(1.0) - pool) * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    z = F.try_divide(p1 - p2, F.nullif(se, F.lit(0.0)))
    s = t.select("n1", "n2", "x1", "x2", p1.alias("p1"), p2.alias("p2"),
                 (n1 * p1 >= MIN_EXPECTED).alias("check_n1_p1"),
                 (n1 * (F.lit(1.0) - p1) >= MIN_EXPECTED).alias("check_n1_q1"),
                 (n2 * p2 >= MIN_EXPECTED).alias("check_n2_p2"),
                 (n2 * (F.lit(1.0) - p2) >= MIN_EXPECTED).alias("check_n2_q2"),
                 pool.alias("p_pool"), se.alias("se"), z.alias("z_stat"))
    # the decision is on the unrounded value
    s = s.withColumn("p_value", norm_cdf(F.col("z_stat"))).withColumn("reject_h0", F.col("p_value") < alpha)
    return s.withColumn("p_value", F.round("p_value", 6)).select(*s.columns).withColumn("z_stat", F.round("z_stat", 6)) \
        .withColumn("se", F.round("se", 8)).withColumn("p_pool", F.round("p_pool", 8))


def chi_square_2x2(df: DataFrame, group_flag: str = "used_ai_suggest", outcome: str = "is_churned") -> DataFrame:
    """Pearson chi-square on the 2x2 table with Yates' continuity correction (df = 1)."""
    t = contingency_2x2(df, group_flag, outcome)
    n1, n2, x1, x2 = (F.col(c).cast("double") for c in ("n1", "n2", "x1", "x2"))
    cells = [(x1, n1, x1 + x2), (n1 - x1, n1, (n1 - x1) + (n2 - x2)),
             (x2, n2, x1 + x2), (n2 - x2, n2, (n1 - x1) + (n2 - x2))]
    total = n1 + n2
    stat = F.lit(0.0)
    for obs, row, colsum in cells:
        exp = F.try_divide(row * colsum, total)  # a margin of 0 leaves the statistic undefined: NULL
        d = F.abs(obs - exp)
        stat = stat + F.try_divide(F.pow(d - F.least(F.lit(0.5), d), F.lit(2)), exp)
    out = t.select(F.round(stat, 6).alias("chi2"), F.lit(1).alias("dof"))
    return out.withColumn("p_value", F.round(chi2_sf_df1(F.col("chi2")), 6))


# --------------------------------------------------------------------------- P10
def rate_by(df: DataFrame, dim: str, outcome: str = "is_churned") -> DataFrame:
    """Size, churned count, churn rate (%) and share of all churn per value of ``dim``."""
    g = df.groupBy(dim).agg(F.count(F.lit(1)).alias("customers"),
                            F.count_if(F.col(outcome)).alias("churned"))
    # grand totals by a window over the grouped rows, one per value of the dimension
    whole = Window.partitionBy()
    j = g.withColumns({"_all": F.sum("churned").over(whole), "_n": F.sum("customers").over(whole)})
    return j.select(dim, "customers", "churned",
                    F.round(F.col("churned").cast("decimal(20,0)") * 100 / F.col("customers"), 1)
                    .cast("double").alias("churn_rate_pct"),
                    F.round(F.col("customers").cast("decimal(20,0)") * 100 / F.col("_n"), 1)
                    .cast("double").alias("share_of_customers_pct"),
                    F.round(F.col("churned").cast("decimal(20,0)") * 100 / F.nullif(F.col("_all"), F.lit(0)), 1)
                    .cast("double").alias("share_of_churn_pct"))
