import datetime as dt
import json

from pyspark.sql import functions as F

from lapse.plans import analysis as A
from lapse.plans import events as E
from lapse.plans import relational as R
from lapse.sources.tables import RAW_ACTIVITY_SCHEMA, read_json_documents

D = dt.date


def test_duplicate_accounts_traps(spark):
    ents = spark.createDataFrame([
        (1201, "Acme Labs ", "ops+work@acmelabs.com", D(2024, 3, 15)),
        (1202, "AcmeLabs", "billing@AcmeLabs.com", D(2024, 3, 15)),
        (1, "Blue  Fox", "nobody", D(2024, 1, 1)),          # no '@': domain ''
        (2, "blue fox", "nobody2", D(2024, 6, 1)),          # same name + same '' domain -> 2
        (3, "Red One", None, D(2024, 1, 1)),                # NULL e-mail never matches a domain
        (4, "Red Two", None, D(2024, 1, 3)),                # same token, len diff 0, signup 2 days -> 2
        (5, "   ", "x@y.com", D(2024, 1, 1)),               # blank name dropped
    ], "customer_id long, company_name string, contact_email string, signup_date date")
    got = {(r["cust_a_id"], r["cust_b_id"]): (r["same_domain"], r["similar_name"], r["similar_signup"],
                                              r["match_score"], r["duplicate_confidence"])
           for r in R.duplicate_accounts(ents).collect()}
    assert got[(1201, 1202)] == (1, 0, 1, 2, "MEDIUM — probable duplicate")  # first tokens acme vs acmelabs
    assert got[(1, 2)] == (1, 1, 0, 2, "MEDIUM — probable duplicate")
    assert got[(3, 4)] == (0, 1, 1, 2, "MEDIUM — probable duplicate")
    assert set(got) == {(1201, 1202), (1, 2), (3, 4)}


def test_shared_member_domains(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "cust_a_id long, cust_b_id long")
    members = spark.createDataFrame([
        (10, 1, "a@x.com", True), (11, 1, "b@y.com", True), (12, 1, "c@z.com", False),
        (20, 2, "d@X.com", True), (21, 2, "e@q.com", True)], "member_id long, customer_id long, email string, "
                                                            "is_active boolean")
    got = {(r[0], r[1]): (r[2], r[3]) for r in R.shared_member_domains(pairs, members).collect()}
    assert got == {(1, 2): (2, 1), (1, 3): (2, 0)}


def _plans(spark):
    return spark.createDataFrame([(1, "1-URGENT", "enterprise", 100), (2, "2-HIGH", "professional", 80),
                                  (4, "4-NOT", "free", 40)], "plan_id int, plan_name string, plan_tier string, "
                                                             "monthly_price_usd int") \
        .withColumn("monthly_price_usd", F.col("monthly_price_usd").cast("decimal(12,2)"))


def test_friction_window_is_half_open(spark):
    subs = spark.createDataFrame([(1, 7, 1, "active", D(2001, 1, 1)), (2, 7, 4, "active", D(2001, 7, 1))],
                                 "subscription_id long, customer_id long, plan_id int, status string, start_date date")
    day = dt.datetime(2001, 7, 1)
    tickets = spark.createDataFrame(
        [("t1", 7, day), ("t2", 7, day - dt.timedelta(days=30)), ("t3", 7, day - dt.timedelta(days=1)),
         ("t4", 7, day - dt.timedelta(days=2)), ("t5", 7, day - dt.timedelta(days=3)),
         ("t6", 7, day - dt.timedelta(days=31))], "ticket_id string, customer_id long, created_at timestamp_ntz")
    cust = spark.createDataFrame([(7, "C", "I", "small", True, None)],
                                 "customer_id long, company_name string, industry string, company_size string, "
                                 "is_active boolean, churn_reason string")
    out = R.friction_downgrades(cust, subs, _plans(spark), tickets, as_of=dt.datetime(2001, 8, 1)).collect()
    # t2 (exactly d - 30 days) counts, t1 (exactly d) and t6 do not: 4 tickets > 3
    assert [(r["customer_id"], r["tickets_prior_30d"], r["prev_plan_tier"], r["new_plan_tier"]) for r in out] == \
        [(7, 4, "enterprise", "free")]


def test_churn_trend_gaps_and_frames(spark):
    rows = []
    sid = 0
    # enterprise: months Jan, Feb, (gap) Apr; churn in Feb only (cancelled ends in Feb)
    for month, n, cancelled in ((1, 2, 0), (2, 4, 2), (4, 1, 0)):
        for i in range(n):
            sid += 1
            status = "cancelled" if i < cancelled else "active"
            start = D(2001, month, 2)
            end = start + dt.timedelta(days=3) if status == "cancelled" else None
            rows.append((sid, sid, 1, status, start, end))
    subs = spark.createDataFrame(rows, "subscription_id long, customer_id long, plan_id int, status string, "
                                       "start_date date, end_date date")
    out = [r.asDict() for r in R.churn_trend(subs, _plans(spark)).collect()]
    assert [(r["month"], r["new_subs"], r["churned"]) for r in out] == \
        [(D(2001, 1, 1), 2, 0), (D(2001, 2, 1), 4, 2), (D(2001, 4, 1), 1, 0)]
    assert [r["mom_new_sub_growth_pct"] for r in out] == [None, 100.0, -75.0]  # LAG steps over the gap
    assert [r["monthly_churn_rate_pct"] for r in out] == [0.0, 50.0, 0.0]
    assert [r["rolling_3m_avg_churn_pct"] for r in out] == [0.0, 25.0, 16.6667]
    assert [r["churn_flag"] for r in out] == [None, None, None]  # a 2-row frame can never flag


def test_funnel_golden_dropoffs(spark):
    counts = [2031, 1038, 668, 521, 268]
    rows = []
    for i, step in enumerate(E.FUNNEL_STEPS):
        rows += [(m, step, i + 1, True, dt.datetime(2024, 1, 1)) for m in range(counts[i])]
    schema = "member_id long, step string, step_index int, completed boolean, timestamp timestamp_ntz"
    df = spark.createDataFrame(rows, schema)
    got = [(r["step"], r["users"], r["dropoff_pct"]) for r in E.onboarding_funnel(df).collect()]
    assert [g[1] for g in got] == counts
    assert [g[2] for g in got] == [0.0, 48.89, 35.65, 22.01, 48.56]
    nested = E.onboarding_funnel_nested(df).first()["funnel"]
    assert nested["first_login"]["dropoff_from_signup_pct"] == 48.89
    # rows without a member id collapse into ONE pseudo-user
    nulls = [(None, "signup", 1, True, dt.datetime(2024, 1, 1)), (None, "signup", 1, True, dt.datetime(2024, 1, 2))]
    got = E.onboarding_funnel(spark.createDataFrame(rows + nulls, schema)).first()
    assert got["users"] == 2032


def test_funnel_steps_are_independent(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "workspace_created", 3, True, t), (1, "first_project", 4, True, t),
                                (2, "first_project", 4, True, t)],
                               "member_id long, step string, step_index int, completed boolean, "
                               "timestamp timestamp_ntz")
    got = {r["step"]: (r["users"], r["dropoff_pct"]) for r in E.onboarding_funnel(df).collect()}
    assert got["first_project"] == (2, -100.0)   # no ordering between steps: drop-off can be negative
    assert got["first_login"] == (0, 100.0)     # 1 - 0 / max(0, 1)


def test_upsell_score_golden(spark):
    t = dt.datetime(2024, 1, 1, 10)
    logs = spark.createDataFrame(
        [(848, 792, t, "feature_click", "gantt", 1800.0), (848, 792, t, "feature_click", "gantt", None)],
        "member_id long, customer_id long, ts timestamp_ntz, event_type string, feature string, "
        "session_duration_sec double")
    r = E.upsell_candidates(logs).first()
    assert (r["engagement_score"], r["upsell_priority"], r["has_long_session"], r["days_active"]) == \
        (38, "LOW", True, 1)


def test_session_cadence_traps(spark):
    t = dt.datetime(2024, 1, 1, 10)
    logs = spark.createDataFrame(
        [(1, 4, t, 1.0), (1, 4, t, 2.0), (1, 4, t, 3.0), (1, 4, t + dt.timedelta(days=7), None),
         (2, -3, t, None)],
        "member_id long, customer_id long, ts timestamp_ntz, session_duration_sec double")
    got = {r["tier"]: r.asDict() for r in E.session_cadence(logs).collect()}
    assert got["free"]["user_count"] == 2                       # 4 % 4 = 0 and -3 % 4 = -3 are both 'free'
    assert got["free"]["avg_sessions_per_week"] == 1.5          # (2 weeks: 3 and 1 events -> 2) and 1 -> 1.5
    assert got["free"]["avg_p75_session_duration_sec"] == 2.0   # user 2 has no durations: ignored by the mean


def test_ztest_and_chi_square_golden(spark):
    rows = [(True, i < 44) for i in range(176)] + [(False, i < 53) for i in range(224)]
    df = spark.createDataFrame(rows, "used_ai_suggest boolean, is_churned boolean")
    z = A.two_proportion_ztest(df).first()
    assert (z["n1"], z["x1"], z["n2"], z["x2"]) == (176, 44, 224, 53)
    assert round(z["z_stat"], 4) == 0.3102 and round(z["p_value"], 4) == 0.6218 and not z["reject_h0"]
    c = A.chi_square_2x2(df).first()
    assert round(c["chi2"], 4) == 0.0371 and round(c["p_value"], 4) == 0.8472 and c["dof"] == 1


def test_m0_document_round_trip(spark, tmp_path):
    docs = [
        {"member_id": "5", "customer_id": 12, "timestamp": "2024-01-05T10:11:12Z", "event_type": "feature_click",
         "feature": "gantt", "session_duration_sec": 30},
        {"userId": 6, "customerId": "13.0", "timestamp": "01/05/2024 10:11:12", "event_type": "feature_click"},
        {"userID": "7", "customerID": "14", "timestamp": "2024-01-05 10:11:12"},
        {"member_id": "8", "customer_id": "12.5", "timestamp": "2024-01-05 10:11:12"},   # fractional id -> dropped
        {"member_id": "9", "customer_id": "15", "timestamp": "junk"},                   # bad time -> dropped
    ]
    p = tmp_path / "logs.json"
    p.write_text("\n".join(json.dumps(d) for d in docs))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        raw = read_json_documents(spark, str(p), RAW_ACTIVITY_SCHEMA)
        got = sorted((r["member_id"], r["customer_id"], r["ts"]) for r in E.normalize_events(raw).collect())
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    t = dt.datetime(2024, 1, 5, 10, 11, 12)
    assert got == [(5, 12, t), (6, 13, t), (7, 14, t)]


def test_orphans_and_dedupe_properties(spark):
    ev = spark.createDataFrame([(1, 1, "f", 1), (1, 1, "f", 1), (2, 99, "g", 2), (3, 2, "h", 3)],
                               "member_id long, customer_id long, feature string, ts long")
    cust = spark.createDataFrame([(1,), (2,)], "customer_id long")
    kept = E.drop_orphans(ev, cust)
    orphans = ev.join(cust, "customer_id", "left_anti")
    assert kept.count() + orphans.count() == ev.count()
    audit = E.orphan_audit(ev, cust).first()
    assert (audit["rows_before"], audit["rows_after"], audit["dropped"]) == (4, 3, 1)
    once = E.dedupe_events(kept)
    assert once.count() == 2 and E.dedupe_events(once).count() == 2


def test_segmentation_labels_and_export(spark, tmp_path):
    from lapse.plans import segment as S
    rows = []
    for i in range(60):
        tier = i % 3  # three well separated groups
        rows.append((i, float(10 + 100 * tier + i % 5), tier * 10, tier * 50, tier * 5, 1.0 * tier * 1000,
                     float(tier * 20), tier == 0))
    df = spark.createDataFrame(rows, "customer_id long, mrr_usd double, ticket_count long, "
                                     "total_feature_clicks long, distinct_features_used long, "
                                     "total_session_sec double, months_since_signup double, is_churned boolean")
    seg, stats, centres = S.segment_customers(df, restarts=3, checkpoint=False)
    by_label = {r["segment_label"]: r for r in stats.collect()}
    assert set(by_label) == set(S.SEGMENT_LABELS)
    assert sum(r["count"] for r in by_label.values()) == 60
    mrr = [by_label[label]["avg_mrr"] for label in S.SEGMENT_LABELS]
    assert mrr == sorted(mrr)                                  # labels follow ascending mean MRR
    cen = {r["segment_label"]: r["mrr_usd"] for r in centres.collect()}
    assert all(abs(cen[k] - by_label[k]["avg_mrr"]) < 0.01 for k in cen)   # centres back in original units
    out = tmp_path / "dash"
    S.export_dashboard(seg, str(out))
    back = spark.read.option("header", True).csv(str(out))
    assert back.count() == 60 and back.columns == [c for c in S.EXPORT_COLUMNS if c in seg.columns]


def test_funnel_from_json_documents(spark, tmp_path):
    from lapse.sources.tables import RAW_ONBOARDING_SCHEMA
    docs = [{"member_id": "1", "step": "signup", "completed": True, "timestamp": "2024-01-01T00:00:00Z"},
            {"memberId": "2", "step": "signup", "completed": True},
            {"memberId": "2", "step": "first_login", "completed": True},
            {"member_id": "3", "step": "first_login", "completed": False},
            {"member_id": "4", "step": "unknown_step", "completed": True}]
    p = tmp_path / "onb.json"
    p.write_text("\n".join(json.dumps(d) for d in docs))
    raw = read_json_documents(spark, str(p), RAW_ONBOARDING_SCHEMA)
    got = [(r["step"], r["users"], r["dropoff_pct"]) for r in E.onboarding_funnel(raw).collect()]
    assert got[:2] == [("signup", 2, 0.0), ("first_login", 1, 50.0)]


def test_transitions_since_matches_full_history(spark):
    import random
    rnd = random.Random(4)
    rows = [(i, rnd.choice([1, 1, 2, 3]), rnd.randint(1, 5),
             rnd.choice([None] + [D(2001, 1, 1) + dt.timedelta(days=rnd.randint(0, 200))] * 8)) for i in range(200)]
    subs = spark.createDataFrame(rows, "subscription_id long, customer_id long, plan_id int, start_date date")
    since = D(2001, 5, 1)
    full = R.plan_transitions(subs).where(F.col("transition_date") >= F.lit(since))
    part = R.transitions_since(subs, since)
    key = lambda r: (r["subscription_id"], r["prev_plan_id"])
    assert sorted(map(key, part.collect())) == sorted(map(key, full.collect()))


def test_feature_return_window_edges(spark):
    t = dt.datetime(2024, 1, 1, 12)
    seven = dt.timedelta(days=7)
    rows = [
        (1, "a", t), (1, "a", t),                                  # same instant again: not a return
        (2, "a", t), (2, "a", t + seven),                          # exactly +7 days: a return
        (3, "a", t), (3, "a", t + seven + dt.timedelta(seconds=1)),  # just after: not a return
        (4, "a", t - dt.timedelta(days=400)), (4, "a", t),          # long gap, then more use: not a return
        (4, "a", t + dt.timedelta(days=1)),
    ]
    logs = spark.createDataFrame([(m, f, ts, "feature_click") for m, f, ts in rows],
                                 "member_id long, feature string, ts timestamp_ntz, event_type string")
    got = {r["member_id"]: r["returned"] for r in E.feature_first_use(logs).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 0}


def test_duplicate_accounts_pairs_of_equal_accounts_use_all_partitions(spark):
    """Accounts of equal values meet as one row: their pairs still come from several tasks, each pair once."""
    rows = spark.range(600).selectExpr("id as customer_id", "concat('Acme ', elt(int(id % 2) + 1, 'One', 'Two')) as company_name",
                                       "concat('u', id, '@d', id % 3, '.com') as contact_email", "date'2024-01-01' + int(id % 40) as signup_date")
    members = spark.range(600).selectExpr("id % 11 as member_id", "id as customer_id", "concat('s@h', id % 5, '.com') as email", "true as is_active")
    for edits in (None, 3):
        out = R.duplicate_accounts(rows, ordered=False, max_edits=edits)
        pairs = [(r.cust_a_id, r.cust_b_id) for r in out.collect()]
        want = {(a, b) for a in range(600) for b in range(a + 1, 600) if (a % 3 == b % 3) + 1 + (abs(a % 40 - b % 40) <= 7) >= 2}
        assert len(pairs) == len(want) and set(pairs) == want
        assert out.select(F.spark_partition_id()).distinct().count() > 3  # three joins, each by more than one task
    evidence = R.duplicate_member_evidence(rows, members)
    assert evidence.count() == len(want)
    assert evidence.select(F.spark_partition_id()).distinct().count() > 3


def test_the_call_that_fits_segments_reads_the_frame_it_wrote(spark, monkeypatch):
    from lapse import queries as Q
    from lapse.plans import segment as S

    rows = spark.range(90).selectExpr("id as customer_id", "double(id % 3 * 1000 + id) as mrr_usd", "id % 3 * 7 as total_feature_clicks",
                                      "if(id % 10 = 0, null, id % 5) as distinct_features_used", "double(id % 3) as total_session_sec",
                                      "id % 4 as ticket_count", "double(id % 6) as months_since_signup", "id % 2 = 0 as is_churned")
    monkeypatch.setattr(Q, "_MODELS", {})
    monkeypatch.setattr(Q, "_merged", lambda d: rows)
    df, model = Q._segments(spark, "no tables")
    assert df.inputFiles() and df.count() == 90 and df.columns == rows.columns
    again, same = Q._segments(spark, "no tables")
    assert same is model and not again.inputFiles()  # fitted before: the files may be gone by now
    a, b = (sorted(map(tuple, S.profile(model.assign(x)).collect())) for x in (df, again))
    assert a == b and sum(r[2] for r in a) == 90
    assert S.fit_segments(rows).labels == model.labels


def test_pair_joins_compare_names_once_and_score_by_class(spark):
    rows = spark.range(300).selectExpr("id as customer_id", "concat('acme x', id % 4) as company_name",
                                       "concat('a@d', id % 5, '.com') as contact_email", "date_add(date'2024-01-01', int(id % 20)) as signup_date")
    out = R.duplicate_accounts(rows, ordered=False, max_edits=3)
    # edit distances are taken by the conditions of the three joins, not again for columns whose value these settle
    assert out._jdf.queryExecution().optimizedPlan().toString().count("levenshtein(") == 3
    got = {(r.cust_a_id, r.cust_b_id): (r.same_domain, r.similar_name, r.similar_signup, r.match_score) for r in out.collect()}
    want = {}
    for b in range(300):
        for a in range(b):
            rules = (int(a % 5 == b % 5), 1, int(abs(a % 20 - b % 20) <= 7))
            if sum(rules) >= 2:
                want[a, b] = (*rules, sum(rules))
    assert got == want and out.count() == len(want)


def test_member_evidence_reads_the_members_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(m):
        read.add(1)
        return m

    rows = spark.range(40).selectExpr("id as customer_id", "'acme' as company_name", "'a@d.com' as contact_email", "date'2024-01-01' as signup_date")
    members = spark.range(40).select(F.col("id").alias("customer_id"), F.udf(seen, "long")(F.col("id") % 8).alias("member_id"),
                                     F.concat(F.lit("s@d"), F.col("id") % 3).alias("email"), F.lit(True).alias("is_active"))
    evidence = {(r.cust_a_id, r.cust_b_id): (r.shared_member_emails, r.shared_member_domains)
                for r in R.duplicate_member_evidence(rows, members).collect()}
    emails = {m: len({i % 3 for i in range(40) if i % 8 == m}) for m in range(8)}
    assert evidence == {(a, b): (emails[a % 8], int(a % 3 == b % 3)) for b in range(40) for a in range(b)}
    assert read.value == 40
