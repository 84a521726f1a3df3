"""Registered queries: name -> callable(spark, tables_dir) -> DataFrame.

Each entry wires domain tables (derived by Spark from the stored tables) into
one library operator with the parameters the checks use.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.casting import safe_bigint, safe_double
from .functions.timeparse import iso_week_key, parse_mixed_timestamp
from .operators.interval_join import interval_join
from .operators.pairs import band_self_pairs
from .operators.quantiles import floor_index_quantiles
from .operators.rank import rank_desc
from .plans import analysis as A
from .plans import events as E
from .plans import relational as R
from .plans import segment as S
from .session import cut_lineage, scratch_path
from .sources.documents import activity_documents, first_field, kind_of, read_documents
from .sources.domain import Domain

AS_OF = _dt.datetime(2001, 8, 1)
FLAG_FEATURE = "f0"
# S3 with the report's own parameters finds nothing on these tables; the wider
# window below is the one the correctness check uses (both are registered).
S3_WIDE = dict(lookback_days=365, ticket_window_days=180, min_tickets=3)


def _dom(spark: SparkSession, base: str) -> Domain:
    return Domain(spark, base)


# ----------------------------------------------------------------- relational
def s1_plan_health(spark, base):
    d = _dom(spark, base)
    return R.plan_health(d.plans, d.subscriptions, d.support_tickets, as_of=AS_OF, packed=True)


def s2_ltv_rank(spark, base):
    d = _dom(spark, base)
    return R.ltv_rank(d.customers, d.latest_subscription_of("plan_id"), d.plans, d.billing_invoices)


def s3_friction_downgrades(spark, base):
    d = _dom(spark, base)
    return R.friction_downgrades(d.customers, d.subscriptions, d.plans, d.support_tickets, as_of=AS_OF, **S3_WIDE)


def s3_friction_downgrades_default(spark, base):
    d = _dom(spark, base)
    return R.friction_downgrades(d.customers, d.subscriptions, d.plans, d.support_tickets, as_of=AS_OF)


def s3_friction_downgrades_midday(spark, base):
    """A reference time of 13:00: transitions on the boundary day are a few hours too old."""
    d = _dom(spark, base)
    return R.friction_downgrades(d.customers, d.subscriptions, d.plans, d.support_tickets,
                                 as_of=AS_OF.replace(hour=13), lookback_days=365, ticket_window_days=180, min_tickets=0)


def s3_friction_downgrades_any_ticket(spark, base):
    d = _dom(spark, base)
    return R.friction_downgrades(d.customers, d.subscriptions, d.plans, d.support_tickets, as_of=AS_OF, min_tickets=0)


def s4_churn_trend(spark, base):
    d = _dom(spark, base)
    return R.churn_trend(d.subscriptions, d.plans)


def s5_duplicate_accounts(spark, base):
    # The pair list is the large output of this workload; presenting it sorted
    # (ordered=True) costs a sampling pass over the whole pipeline plus a full
    # shuffle, so the registered query returns it unsorted.
    d = _dom(spark, base)
    return R.duplicate_accounts(d.duplicate_entities, ordered=False)


def s5_duplicate_accounts_strict(spark, base):
    """Names are similar only within three edits of each other."""
    return R.duplicate_accounts(_dom(spark, base).duplicate_entities, ordered=False, max_edits=3)


def j3_similar_names(spark, base):
    return R.similar_names(_dom(spark, base).duplicate_entities, 3)


def j3_similar_labels(spark, base):
    """Names with the account's e-mail domain behind them: many more, longer texts."""
    return R.similar_names(_dom(spark, base).duplicate_entities, 2, F.concat_ws(" ", "name", "domain"))


def s5b_shared_member_domains(spark, base):
    d = _dom(spark, base)
    return R.duplicate_member_evidence(d.duplicate_entities, d.team_members)


# ----------------------------------------------------------------- events
def _clean_raw(d: Domain) -> DataFrame:
    return E.normalize_events(d.raw_activity_logs)


def _clean_events(d: Domain) -> DataFrame:
    """Raw documents -> normalised -> events of named customers -> one of each set of copies."""
    return E.dedupe_events(E.drop_orphans(_clean_raw(d), A.named_customers(d.customers)))


def _merged_raw(d: Domain) -> DataFrame:
    clicks = _clean_events(d).where(F.col("event_type") == "feature_click")
    return A.months_since(A.engagement_features(A.fill_defaults(_base(d)), clicks, FLAG_FEATURE))


def m1_session_cadence_raw(spark, base):
    """Member ids may be texts."""
    return E.session_cadence(E.member_events(_dom(spark, base).raw_activity_logs))


def m2_feature_retention_raw(spark, base):
    """Retention needs a member and a time only: events with a bad customer id count."""
    return E.feature_retention(E.member_events(_dom(spark, base).raw_activity_logs, need_customer=False))


def m4_upsell_candidates_raw(spark, base):
    return E.upsell_candidates(E.member_events(_dom(spark, base).raw_activity_logs), k=20)


def p5_engagement_features_raw(spark, base):
    return _merged_raw(_dom(spark, base)).select(
        "customer_id", "used_ai_suggest", "ai_suggest_clicks", "total_feature_clicks", "distinct_features_used",
        "total_session_sec")


def p6_two_proportion_ztest_raw(spark, base):
    return A.two_proportion_ztest(_merged_raw(_dom(spark, base)))


def p7_chi_square_2x2_raw(spark, base):
    return A.chi_square_2x2(_merged_raw(_dom(spark, base)))


def p10_rate_by_ai_adoption_raw(spark, base):
    return A.rate_by(_merged_raw(_dom(spark, base)), "used_ai_suggest")


def m0_normalize_events(spark, base):
    return _clean_raw(_dom(spark, base))


def m0_document_scan(spark, base):
    """The same events from a dump of documents whose ids and times are numbers, texts and dates by turns."""
    path = scratch_path(spark, "documents")
    _dom(spark, base).activity_dump.write.text(path)
    docs = activity_documents(read_documents(spark, path), E.MEMBER_ID_VARIANTS, E.CUSTOMER_ID_VARIANTS)
    return E.normalize_events(docs)


def op_document_types(spark, base):
    """How often each field has each type in the dump."""
    path = scratch_path(spark, "documents")
    _dom(spark, base).activity_dump.write.text(path)
    docs = read_documents(spark, path)
    kinds = F.array(*[F.struct(F.lit(n).alias("field"), kind_of(first_field("doc", names)).alias("kind")) for n, names in (
        ("member", E.MEMBER_ID_VARIANTS), ("customer", E.CUSTOMER_ID_VARIANTS), ("timestamp", ["timestamp"]), ("feature", ["feature"]))])
    return docs.select(F.explode(kinds).alias("k")).groupBy("k.field", F.coalesce("k.kind", F.lit("missing")).alias("kind")).agg(
        F.count(F.lit(1)).alias("documents"))


def m0_member_events(spark, base):
    return E.member_events(_dom(spark, base).raw_activity_logs)


def m1_session_cadence(spark, base):
    return E.session_cadence(_dom(spark, base).activity_logs)


def m1_session_cadence_by_plan(spark, base):
    d = _dom(spark, base)
    return E.session_cadence(d.activity_logs, tiers=E.current_tiers(d.latest_subscription_of("plan_id"), d.plans))


def m2_feature_retention(spark, base):
    return E.feature_retention(_dom(spark, base).activity_logs)


def m3_onboarding_funnel(spark, base):
    return E.onboarding_funnel(_dom(spark, base).onboarding_events)


def m3_onboarding_funnel_nested(spark, base):
    return E.onboarding_funnel_nested(_dom(spark, base).onboarding_events)


def m3_onboarding_funnel_document(spark, base):
    """The nested document as the text that a document store would print."""
    return E.onboarding_funnel_nested(_dom(spark, base).onboarding_events).select(F.to_json("funnel").alias("funnel"))


def m3b_step_gap_median(spark, base):
    return E.step_gap_median(_dom(spark, base).onboarding_events)


def m4_upsell_candidates(spark, base):
    return E.upsell_candidates(_dom(spark, base).activity_logs, k=20)


def m4_upsell_candidates_free(spark, base):
    d = _dom(spark, base)
    tiers = E.current_tiers(d.latest_subscription_of("plan_id"), d.plans)
    return E.upsell_candidates(d.activity_logs, k=20, tiers=tiers, tier="free")


# ----------------------------------------------------------------- analysis frame
def _base(d: Domain) -> DataFrame:
    return A.customer_base(d.customers, d.latest_subscription, d.plans, d.support_tickets)


def _clicks(d: Domain) -> DataFrame:
    """Feature-click events (the analysis reads only these, like its source query)."""
    return d.activity_logs.where(F.col("event_type") == "feature_click")


def _merged(d: Domain, winsorize: bool = True) -> DataFrame:
    b = A.fill_defaults(_base(d))
    if winsorize:
        b, _ = A.cap_at_quantile(b, "mrr_usd", 0.99)
    return A.months_since(A.engagement_features(b, _clicks(d), FLAG_FEATURE))


def p1_customer_base(spark, base):
    return _base(_dom(spark, base))


def p2_drop_orphans(spark, base):
    d = _dom(spark, base)
    return E.drop_orphans(_clean_raw(d), A.named_customers(d.customers))


def p2_orphan_audit(spark, base):
    d = _dom(spark, base)
    return E.orphan_audit(_clean_raw(d), A.named_customers(d.customers))


def p2_dedupe_events(spark, base):
    d = _dom(spark, base)
    return E.dedupe_events(E.drop_orphans(_clean_raw(d), A.named_customers(d.customers)))


def p2_first_feature_use(spark, base):
    """The first event in the stored order of each member and feature, whatever the events hold."""
    logs = _dom(spark, base).stored_activity_logs
    return E.keep_first(logs, ["member_id", "feature"]).select("member_id", "feature", "event_id", "ts", "event_type", "session_duration_sec")


def p3_fill_defaults(spark, base):
    return A.fill_defaults(_base(_dom(spark, base))).select(
        "customer_id", "plan_tier", "industry", "company_size", "country_code", "mrr_usd", "ticket_count")


def p4_winsorize_mrr(spark, base):
    b = A.fill_defaults(_base(_dom(spark, base)))
    capped, _ = A.cap_at_quantile(b, "mrr_usd", 0.99)
    return capped.select("customer_id", "mrr_usd")


def p5_engagement_features(spark, base):
    d = _dom(spark, base)
    m = A.engagement_features(A.fill_defaults(_base(d)), _clicks(d), FLAG_FEATURE)
    return m.select("customer_id", "used_ai_suggest", "ai_suggest_clicks", "total_feature_clicks",
                    "distinct_features_used", "total_session_sec")


def p6_two_proportion_ztest(spark, base):
    return A.two_proportion_ztest(_merged(_dom(spark, base), winsorize=False))


def p7_chi_square_2x2(spark, base):
    return A.chi_square_2x2(_merged(_dom(spark, base), winsorize=False))


_MODELS: dict[tuple[str, str], S.SegmentModel] = {}


def _segments(spark: SparkSession, base: str) -> tuple[DataFrame, S.SegmentModel]:
    """The merged frame and its segmentation, fitted once per application and folder of tables.

    The call that fits writes the frame for it and returns what it wrote, so its report does not work the frame out again.
    """
    df, key = _merged(_dom(spark, base)), (spark.sparkContext.applicationId, base)
    if key not in _MODELS:
        df = cut_lineage(df.fillna(0, subset=list(S.SEGMENT_FEATURES)))
        _MODELS[key] = S.fit_written(df)
    return df, _MODELS[key]


def p8_segment_customers(spark, base):
    df, model = _segments(spark, base)
    return S.profile(model.assign(df)).select("segment_label", "count", "avg_mrr", "avg_clicks", "avg_features", "churn_rate")


def p9_export_dashboard(spark, base):
    df, model = _segments(spark, base)
    return S.export_frame(model.assign(df))


def p8_segment_facts(spark, base):
    """What holds for the segments whatever their labels: everyone has one, and labels follow the mean MRR."""
    df, model = _segments(spark, base)
    seg = model.assign(df)
    stats = S.profile(seg)
    by_mrr = F.transform(F.array_sort(F.collect_list(F.struct("avg_mrr", "segment_label"))), lambda x: x["segment_label"])
    return seg.agg(F.count(F.lit(1)).alias("customers"), F.count_distinct("segment").alias("segments"),
                   F.count_if(F.col("segment").isNull()).alias("without_segment")).withColumn(
        "labels_by_mrr", stats.agg(F.array_join(by_mrr, ",")).scalar())  # stats has k rows


def p8_centre_facts(spark, base):
    return S.centre_facts(*_segments(spark, base))


def p8_profile_totals(spark, base):
    """The segments' profile summed up again: sizes and means weighted by them are those of all customers."""
    df, model = _segments(spark, base)
    seg = model.assign(df)
    per = seg.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.avg("mrr_usd").alias("m"), F.avg("total_feature_clicks").alias("c"),
                                     F.avg(F.col("is_churned").cast("double")).alias("r"))
    total = F.sum("n")
    return per.agg(total.alias("customers"), *[F.round(F.sum(F.col(x) * F.col("n")) / total, 6).alias(name)
                                               for x, name in (("m", "avg_mrr"), ("c", "avg_clicks"), ("r", "churn_rate"))])


def p9_export_without_segment(spark, base):
    """The dashboard's columns apart from the fitted ones."""
    return S.export_frame(_merged(_dom(spark, base)).fillna(0, subset=list(S.SEGMENT_FEATURES)))


def p9_export_written(spark, base):
    """The dashboard's CSV, written (without the fitted columns) and read again as the texts that it holds."""
    path = scratch_path(spark, "dashboard")
    S.export_dashboard(_merged(_dom(spark, base)).fillna(0, subset=list(S.SEGMENT_FEATURES)), path)
    names = [c for c in S.EXPORT_COLUMNS if c not in ("segment", "segment_label")]
    back = spark.read.schema(", ".join(f"{c} string" for c in names)).option("header", True).option("enforceSchema", False).csv(path)
    number = {"mrr_usd", "total_session_sec", "months_since_signup"}
    whole = {"customer_id", "ticket_count", "ai_suggest_clicks", "total_feature_clicks", "distinct_features_used"}
    return back.select(*[F.col(c).cast("double" if c in number else "bigint" if c in whole else "string").alias(c) for c in names])


def p8_cluster_centres(spark, base):
    df, model = _segments(spark, base)
    return model.centre_frame(spark)


def p10_rate_by_tier(spark, base):
    return A.rate_by(A.fill_defaults(_base(_dom(spark, base))), "plan_tier")


# ----------------------------------------------------------------- operator-level checks
def op_dataset_profile(spark, base):
    m = _merged(_dom(spark, base), winsorize=False)
    return A.dataset_profile(m.withColumn("is_active_customer", ~F.col("is_churned")),
                             ["is_churned", "is_active_customer", "used_ai_suggest"])


def op_months_since_signup(spark, base):
    return A.months_since(_base(_dom(spark, base))).select("customer_id", "signup_date", "months_since_signup")


def op_topk_score(spark, base):
    """Top 20 customers by lifetime value (ties by customer id): a bounded top-k, not a sort."""
    d = _dom(spark, base)
    ltv = R.customer_ltv(d.customers, d.latest_subscription_of("plan_id"), d.plans, d.billing_invoices)
    return ltv.orderBy(F.col("ltv_usd").desc(), "customer_id").limit(20) \
        .select("customer_id", "plan_tier", F.col("ltv_usd").cast("double").alias("ltv_usd"))


def op_array_filter_size(spark, base):
    """Per member: sessions of at least 30 minutes (the size of a filtered list, as a count)."""
    logs = _dom(spark, base).activity_logs
    return logs.groupBy("member_id").agg(
        F.count_if(F.col("session_duration_sec") >= E.LONG_SESSION_SEC).alias("long_sessions"),
        F.count(F.lit(1)).alias("sessions"))


def op_latest_per_group(spark, base):
    return _dom(spark, base).latest_subscription_of("subscription_id", "plan_id", "status", "start_date")


def op_plan_transitions(spark, base):
    return R.plan_transitions(_dom(spark, base).subscriptions)


def op_interval_join_tickets(spark, base):
    """Tickets in the 30 days before each subscription start (half-open interval join)."""
    d = _dom(spark, base)
    subs = d.subscriptions.select("subscription_id", "customer_id", "start_date")
    day0 = F.col("w.start_date").cast("timestamp_ntz")
    hits = interval_join(subs, d.support_tickets.select("customer_id", "ticket_id", "created_at"), ["customer_id"],
                         "created_at", lower=day0 - F.make_dt_interval(F.lit(30)), upper=day0, bucket_days=30)
    return hits.groupBy("subscription_id", "customer_id", "start_date").agg(
        F.count("ticket_id").alias("tickets_prior_30d"))


def op_band_pairs_domain_signup(spark, base):
    """Accounts sharing an e-mail domain that signed up within 7 days of each other."""
    acc = R.clean_accounts(_dom(spark, base).duplicate_entities)
    p = band_self_pairs(acc, "customer_id", ["domain"], "signup_day", 7, [])
    return p.select(F.col("customer_id_a").alias("cust_a_id"), F.col("customer_id_b").alias("cust_b_id"))


def op_anti_join_orphans(spark, base):
    d = _dom(spark, base)
    return _clean_raw(d).join(A.named_customers(d.customers).select("customer_id"), "customer_id", "left_anti") \
        .select("member_id", "customer_id", "ts", "event_type", "feature", "session_duration_sec")


def op_rank_ties(spark, base):
    """Distributed RANK of customers by account balance inside each market segment."""
    c = _dom(spark, base).table("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return rank_desc(c, ["c_mktsegment"], "c_acctbal", "acctbal_rank")


def op_conditional_sum(spark, base):
    inv = _dom(spark, base).billing_invoices
    amt = F.col("amount_usd")
    return inv.groupBy("customer_id").agg(*[
        F.sum(F.when(F.col("status") == s, amt).otherwise(F.lit(0))).cast("double").alias(f"{s}_usd")
        for s in ("paid", "refunded", "void")])


def op_count_distinct(spark, base):
    d = _dom(spark, base)
    s = d.subscriptions.join(d.plans.select("plan_id", "plan_tier"), "plan_id")
    return s.groupBy("plan_tier").agg(F.count_distinct("customer_id").alias("customers"),
                                      F.count(F.lit(1)).alias("subscriptions"))


def op_null_profile(spark, base):
    return A.null_profile(_base(_dom(spark, base)))


def op_quantile_p99(spark, base):
    b = A.fill_defaults(_base(_dom(spark, base)))
    _, audit = A.cap_at_quantile(b, "mrr_usd", 0.99)
    return audit.select("cap", "outliers")


def op_floor_index_quartiles(spark, base):
    logs = _dom(spark, base).activity_logs
    return floor_index_quantiles(logs, ["customer_id", "member_id"], "session_duration_sec",
                                 {"p25": 0.25, "p50": 0.5, "p75": 0.75}, count_col="n")


def op_monthly_buckets(spark, base):
    d = _dom(spark, base)
    s = d.subscriptions.join(d.plans.select("plan_id", "plan_tier"), "plan_id")
    return s.where(F.col("start_date").isNotNull()).groupBy(
        "plan_tier", F.trunc("start_date", "month").alias("month")).agg(F.count(F.lit(1)).alias("new_subs"))


def op_iso_week_buckets(spark, base):
    logs = _dom(spark, base).activity_logs
    return logs.groupBy(iso_week_key("ts").alias("week")).agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("member_id").alias("users"))


def op_contingency_2x2(spark, base):
    return A.contingency_2x2(_merged(_dom(spark, base), winsorize=False), "used_ai_suggest", "is_churned")


def op_text_normalize(spark, base):
    acc = R.clean_accounts(_dom(spark, base).duplicate_entities)
    return acc.select("customer_id", "name", "domain", "token", "name_len", "signup_day")


def op_safe_cast_id(spark, base):
    raw = _dom(spark, base).raw_activity_logs
    cid = safe_bigint(F.coalesce("customer_id", "customerId", "customerID_"))
    return raw.select("event_id", "copy", cid.alias("customer_id"))


def op_safe_double(spark, base):
    """Durations as a document store may hold them: numbers, texts of numbers, and other texts."""
    raw = _dom(spark, base).raw_activity_logs
    eid, d = F.col("event_id"), F.col("session_duration_sec")
    text = F.when(eid % 5 == 0, F.concat(F.lit(" "), d.cast("string"))).when(eid % 5 == 1, F.concat(d.cast("bigint").cast("string"), F.lit("e1"))).when(
        eid % 5 == 2, F.lit("n/a")).when(eid % 5 == 3, F.concat(d.cast("string"), F.lit("d"))).otherwise(d.cast("string"))
    return raw.select("event_id", "copy", safe_double(text).alias("seconds"))


def op_mixed_timestamps(spark, base):
    raw = _dom(spark, base).raw_activity_logs
    return raw.select("event_id", "copy", parse_mixed_timestamp("timestamp").alias("ts"))


def op_case_bands(spark, base):
    return E.weekly_engagement_bands(_dom(spark, base).activity_logs)


def p10_rate_by_ai_adoption(spark, base):
    return A.rate_by(_merged(_dom(spark, base), winsorize=False), "used_ai_suggest")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        s1_plan_health, s2_ltv_rank, s3_friction_downgrades, s3_friction_downgrades_default,
        s3_friction_downgrades_midday, s3_friction_downgrades_any_ticket, s4_churn_trend,
        s5_duplicate_accounts, s5_duplicate_accounts_strict, j3_similar_names, j3_similar_labels, s5b_shared_member_domains,
        m0_normalize_events, m0_document_scan, m0_member_events, m1_session_cadence, m1_session_cadence_by_plan, m2_feature_retention,
        m3_onboarding_funnel, m3_onboarding_funnel_nested, m3_onboarding_funnel_document, m3b_step_gap_median, m4_upsell_candidates,
        m4_upsell_candidates_free, m1_session_cadence_raw, m2_feature_retention_raw, m4_upsell_candidates_raw,
        p5_engagement_features_raw, p6_two_proportion_ztest_raw, p7_chi_square_2x2_raw, p10_rate_by_ai_adoption_raw,
        p1_customer_base, p2_drop_orphans, p2_orphan_audit, p2_dedupe_events, p2_first_feature_use, p3_fill_defaults, p4_winsorize_mrr,
        p5_engagement_features, p6_two_proportion_ztest, p7_chi_square_2x2, p8_segment_customers,
        p8_cluster_centres, p8_segment_facts, p8_centre_facts, p8_profile_totals, p9_export_dashboard, p9_export_without_segment,
        p9_export_written, p10_rate_by_tier, p10_rate_by_ai_adoption,
        op_dataset_profile, op_months_since_signup, op_topk_score, op_array_filter_size, op_latest_per_group,
        op_plan_transitions, op_interval_join_tickets, op_band_pairs_domain_signup,
        op_anti_join_orphans, op_rank_ties, op_conditional_sum, op_count_distinct, op_null_profile,
        op_quantile_p99, op_floor_index_quartiles, op_monthly_buckets, op_iso_week_buckets, op_contingency_2x2,
        op_text_normalize, op_safe_cast_id, op_safe_double, op_document_types, op_mixed_timestamps, op_case_bands,
    )
}
