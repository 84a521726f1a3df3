"""Relational retention reports: plan health, LTV rank, friction downgrades,
churn trend, duplicate accounts.

Each report is a function of DataFrames (domain tables) and parameters that
returns a lazy DataFrame. Money stays DECIMAL through the arithmetic and is
rounded half-up, then exposed as DOUBLE.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_token, normalize_name, email_domain
from ..functions.timeparse import as_datetime, month_floor_minus, ntz_literal
from ..operators.bitsets import bitsets, dense_numbers, shared_values
from ..operators.edit_join import similar_texts
from ..operators.interval_join import interval_join
from ..operators.lag import chunked_lag
from ..operators.latest import latest_per
from ..operators.pairs import band_self_pairs
from ..operators.rank import rank_desc
from ..session import cut_lineage

# Labels printed by the reports.
CHURN_SPIKE_FLAG = "🚨 CHURN SPIKE (>2× rolling avg)"
DUPLICATE_LABELS = ("HIGH — likely duplicate", "MEDIUM — probable duplicate", "LOW — possible duplicate")
BASE_STATUSES = ("active", "cancelled", "paused", "trial")


def _money(c):
    return c.cast("double")


def active_subscriptions(subscriptions: DataFrame, packed: bool = False) -> DataFrame:
    """Latest *active* subscription per customer (``packed``: see :func:`latest_per`)."""
    active = subscriptions.where(F.col("status") == "active")
    return latest_per(active, ["customer_id"], ["start_date", "subscription_id"],
                      columns=["customer_id", "plan_id", "mrr_usd", "start_date", "subscription_id"], packed=packed)


# --------------------------------------------------------------------------- S1
def plan_health(plans: DataFrame, subscriptions: DataFrame, tickets: DataFrame,
                as_of=None, months: int = 6, ordered: bool = True, packed: bool = False) -> DataFrame:
    """Active customers, MRR and support-ticket rate per plan.

    The ticket window starts at the first day of the month ``months`` before
    ``as_of`` and is open-ended above (so it also holds the current partial
    month); the rate still divides by ``months``.
    Tickets are counted per customer before meeting the subscriptions, so the
    join sees one row per customer instead of one per ticket.
    """
    start = month_floor_minus(as_of, months)
    active = active_subscriptions(subscriptions, packed).select("customer_id", "plan_id", "mrr_usd")
    per_customer = (tickets.where(F.col("created_at") >= ntz_literal(start))
                    .groupBy("customer_id").agg(F.count("ticket_id").alias("n")))
    # one pass over the active subscriptions: members, MRR and their tickets per plan
    per_plan = active.join(per_customer, "customer_id", "left").groupBy("plan_id").agg(
        F.count("customer_id").alias("active_customers"),  # one row per customer after latest_per
        F.round(F.avg("mrr_usd"), 2).alias("avg_mrr_usd"),
        F.sum("mrr_usd").alias("total_mrr_usd"),
        F.sum("n").alias("total_tickets"))
    pc = plans.join(per_plan, "plan_id", "left")
    active_n = F.coalesce(F.col("active_customers"), F.lit(0))
    rate = F.when(active_n == 0, F.lit(0).cast("decimal(38,4)")).otherwise(
        F.round(F.coalesce(F.col("total_tickets"), F.lit(0)).cast("decimal(20,0)")
                / (active_n * F.lit(months)).cast("decimal(20,1)"), 4))
    out = pc.select(
        "plan_name", "plan_tier",
        active_n.cast("bigint").alias("active_customers"),
        _money(F.coalesce(F.col("avg_mrr_usd"), F.lit(0))).alias("avg_mrr_usd"),
        _money(F.coalesce(F.col("total_mrr_usd"), F.lit(0))).alias("total_mrr_usd"),
        rate.cast("double").alias("tickets_per_customer_per_month"),
        F.col("avg_mrr_usd").alias("_sort_mrr"))
    if ordered:
        out = out.orderBy(F.col("plan_tier").asc_nulls_last(), F.col("_sort_mrr").desc_nulls_first())
    return out.drop("_sort_mrr")


# --------------------------------------------------------------------------- S2
def customer_ltv(customers: DataFrame, latest_subscription: DataFrame, plans: DataFrame,
                 invoices: DataFrame) -> DataFrame:
    """customer_id, company_name, plan_tier (latest subscription, any status), ltv_usd (paid only)."""
    tier = latest_subscription.select("customer_id", "plan_id").join(
        plans.select("plan_id", "plan_tier"), "plan_id", "left")
    paid = (invoices.where(F.col("status") == "paid")
            .groupBy("customer_id").agg(F.sum("amount_usd").alias("paid")))
    named = customers.where(F.col("company_name").isNotNull() & (F.col("company_name") != "")) \
        .select("customer_id", "company_name")
    return (named.join(tier.select("customer_id", "plan_tier"), "customer_id", "left")
            .join(paid, "customer_id", "left")
            .select("customer_id", "company_name", "plan_tier",
                    F.coalesce(F.col("paid"), F.lit(0).cast("decimal(28,2)")).alias("ltv_usd")))


def ltv_rank(customers: DataFrame, latest_subscription: DataFrame, plans: DataFrame, invoices: DataFrame,
             ordered: bool = True) -> DataFrame:
    """Rank customers by lifetime value inside their plan tier, with % gap to the tier mean.

    The rank comes from bucketed prefix counts (:mod:`lapse.operators.rank`),
    not one window task per tier, and the tier mean is a grouped aggregate
    joined back (one row per tier).
    """
    # one row per customer, read by the rank and the tier mean; their plans share the exchanges of its aggregates
    ltv = customer_ltv(customers, latest_subscription, plans, invoices)
    ranked = rank_desc(ltv, ["plan_tier"], "ltv_usd", "tier_rank")
    # mean as exact decimal sum / count in double: a DECIMAL quotient would be cut to
    # 6 decimals and the percentage below rounded from a truncated value
    # (from the values and their counts that the rank is made of)
    n = F.col("n").cast("decimal(20,0)")
    tier_avg = ltv.groupBy("plan_tier", "ltv_usd").agg(F.count(F.lit(1)).alias("n")).groupBy("plan_tier").agg(
        (F.sum(F.col("ltv_usd") * n).cast("double") / F.sum(F.when(F.col("ltv_usd").isNotNull(), F.col("n")))).alias("tier_avg"))
    j = ranked.join(tier_avg, ranked.plan_tier.eqNullSafe(tier_avg.plan_tier), "left") \
        .drop(tier_avg.plan_tier)
    avg = F.col("tier_avg")
    ltv_d = F.col("ltv_usd").cast("double")
    pct = F.round((ltv_d - avg) / F.nullif(avg, F.lit(0.0)) * 100, 2)
    out = j.select(
        F.coalesce(F.col("plan_tier"), F.lit("unknown")).alias("plan_tier"),
        F.col("tier_rank").cast("bigint").alias("tier_rank"),
        "company_name",
        _money(F.round(F.col("ltv_usd"), 2)).alias("ltv_usd"),
        _money(F.round(avg, 2)).alias("tier_avg_ltv_usd"),
        _money(pct).alias("pct_diff_from_tier_avg"))
    if ordered:
        out = out.orderBy(F.col("plan_tier").asc_nulls_last(), F.col("tier_rank").asc_nulls_last())
    return out


# --------------------------------------------------------------------------- S3
def plan_transitions(subscriptions: DataFrame, buckets: int | None = None) -> DataFrame:
    """Each subscription with the plan of the customer's previous subscription
    (ordered by start_date ASC NULLS LAST, then subscription_id).

    A customer with a huge subscription history is split into start-date
    chunks (:func:`lapse.operators.lag.chunked_lag`) instead of one window task.
    """
    s = subscriptions.select("customer_id", "subscription_id", "plan_id", "start_date")
    t = chunked_lag(s, ["customer_id"], ["start_date", "subscription_id"], ["plan_id"], buckets=buckets)
    return t.select("customer_id", "subscription_id", F.col("plan_id").alias("new_plan_id"),
                    F.col("start_date").alias("transition_date"), F.col("prev_plan_id"))


def transitions_since(subscriptions: DataFrame, since: _dt.date | _dt.datetime, buckets: int | None = None) -> DataFrame:
    """``plan_transitions`` restricted to transitions on or after ``since``, without
    ordering the whole history: only the recent slice (a filter that reaches the
    scan) is windowed; the predecessor of a customer's first recent subscription is
    the latest older one, a combinable max(struct) aggregate over the older rows.
    Rows without a start date sort last, so they are never a predecessor of a
    dated row and never a recent transition."""
    s = subscriptions.select("customer_id", "subscription_id", "plan_id", "start_date")
    # a date counts as its midnight: with a time of day, the day that ``since`` falls on is already older
    since = as_datetime(since)
    first_day = since.date() + _dt.timedelta(days=since.time() > _dt.time())
    recent = s.where(F.col("start_date") >= F.lit(first_day))
    older = latest_per(s.where(F.col("start_date") < F.lit(first_day)), ["customer_id"],
                       ["start_date", "subscription_id"], columns=["customer_id", "plan_id"]) \
        .withColumnRenamed("plan_id", "older_plan_id")
    t = chunked_lag(recent, ["customer_id"], ["start_date", "subscription_id"], ["plan_id"], buckets=buckets,
                    first_flag="_first")
    t = t.join(older, "customer_id", "left")
    return t.select("customer_id", "subscription_id", F.col("plan_id").alias("new_plan_id"),
                    F.col("start_date").alias("transition_date"),
                    F.when(F.col("_first"), F.col("older_plan_id")).otherwise(F.col("prev_plan_id"))
                    .alias("prev_plan_id"))


def downgrades(subscriptions: DataFrame, plans: DataFrame, as_of=None, lookback_days: int = 90) -> DataFrame:
    since = as_datetime(as_of) - _dt.timedelta(days=lookback_days)
    t = transitions_since(subscriptions, since)
    pp = plans.select(F.col("plan_id").alias("prev_plan_id"), F.col("plan_name").alias("prev_plan_name"),
                      F.col("plan_tier").alias("prev_plan_tier"), F.col("monthly_price_usd").alias("prev_plan_price"))
    np_ = plans.select(F.col("plan_id").alias("new_plan_id"), F.col("plan_name").alias("new_plan_name"),
                       F.col("plan_tier").alias("new_plan_tier"), F.col("monthly_price_usd").alias("new_plan_price"))
    return (t.join(pp, "prev_plan_id").join(np_, "new_plan_id")
            .where(F.col("new_plan_price") < F.col("prev_plan_price"))
            .select("customer_id", F.col("transition_date").alias("downgrade_date"), "prev_plan_id", "new_plan_id",
                    "prev_plan_name", "prev_plan_tier", "prev_plan_price",
                    "new_plan_name", "new_plan_tier", "new_plan_price"))


def friction_downgrades(customers: DataFrame, subscriptions: DataFrame, plans: DataFrame, tickets: DataFrame,
                        as_of=None, lookback_days: int = 90, ticket_window_days: int = 30,
                        min_tickets: int = 3, ordered: bool = True) -> DataFrame:
    """Downgrades in the last ``lookback_days`` preceded by more than ``min_tickets``
    tickets in the ``ticket_window_days`` before the downgrade (half-open window)."""
    # the downgrade set (one lookback window) feeds the ticket count and the final
    # join; both read the exchange behind its transition window
    as_of = as_datetime(as_of)
    d = downgrades(subscriptions, plans, as_of, lookback_days)
    # no downgrade window can start before this: prune tickets at the scan
    earliest = _dt.datetime.combine(as_of.date() - _dt.timedelta(days=lookback_days + ticket_window_days), _dt.time())
    t = tickets.where(F.col("created_at") >= ntz_literal(earliest)).select("customer_id", "ticket_id", "created_at")
    day0 = F.col("w.downgrade_date").cast("timestamp_ntz")
    hits = interval_join(d.select("customer_id", "downgrade_date"), t, ["customer_id"], "created_at",
                         lower=day0 - F.make_dt_interval(F.lit(ticket_window_days)), upper=day0,
                         bucket_days=ticket_window_days)
    tb = (hits.groupBy("customer_id", "downgrade_date").agg(F.count("ticket_id").alias("tickets_prior_30d"))
          .where(F.col("tickets_prior_30d") > min_tickets))
    c = customers.select("customer_id", "company_name", "industry", "company_size", "is_active", "churn_reason")
    out = d.join(tb, ["customer_id", "downgrade_date"]).join(c, "customer_id").select(
        "customer_id", "company_name", "industry", "company_size", "downgrade_date",
        "prev_plan_name", "prev_plan_tier", _money(F.col("prev_plan_price")).alias("prev_monthly_usd"),
        "new_plan_name", "new_plan_tier", _money(F.col("new_plan_price")).alias("new_monthly_usd"),
        F.col("tickets_prior_30d").cast("bigint").alias("tickets_prior_30d"), "is_active", "churn_reason")
    if ordered:
        out = out.orderBy(F.col("tickets_prior_30d").desc(), F.col("downgrade_date").desc(), "customer_id")
    return out


# --------------------------------------------------------------------------- S4
def monthly_subscription_stats(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """(plan_tier, month) -> new_subs, churned, active_base in ONE scan and ONE shuffle.

    Each subscription contributes a 'start' row (its start month) and an 'end'
    row (its end month); conditional aggregates replace three separate
    grouped scans.
    """
    s = subscriptions.join(plans.select("plan_id", "plan_tier"), "plan_id")
    sides = F.explode(F.array(
        F.struct(F.lit(True).alias("is_start"), F.trunc("start_date", "month").alias("month")),
        F.struct(F.lit(False).alias("is_start"), F.trunc("end_date", "month").alias("month"))))
    rows = s.select("plan_tier", "customer_id", "status", "start_date", "end_date", sides.alias("side"))
    is_start = F.col("side.is_start")
    return rows.groupBy("plan_tier", F.col("side.month").alias("month")).agg(
        F.count_if(is_start & F.col("start_date").isNotNull()).alias("new_subs"),
        F.count_distinct(F.when(~is_start & (F.col("status") == "cancelled") & F.col("end_date").isNotNull(),
                                F.col("customer_id"))).alias("churned"),
        F.count_distinct(F.when(is_start & F.col("status").isin(*BASE_STATUSES),
                                F.col("customer_id"))).alias("active_base"))


def churn_trend(subscriptions: DataFrame, plans: DataFrame, ordered: bool = True) -> DataFrame:
    """Month-over-month new-subscription growth, churn rate, 3-row rolling churn, spike flag.

    Months are those with at least one new subscription (months with churn
    only are not reported); LAG and the rolling frame step over rows.
    """
    m = monthly_subscription_stats(subscriptions, plans).where(F.col("new_subs") > 0)
    w = Window.partitionBy("plan_tier").orderBy("month")
    prev = F.lag("new_subs").over(w)
    growth = F.round((F.col("new_subs") - prev).cast("decimal(20,0)")
                     / F.nullif(prev, F.lit(0)).cast("decimal(20,0)") * 100, 2)
    rate = F.round(F.col("churned").cast("decimal(20,0)")
                   / F.nullif(F.col("active_base"), F.lit(0)).cast("decimal(20,0)") * 100, 4)
    c = m.select("plan_tier", "month", "new_subs", growth.alias("growth"), "churned", rate.alias("rate"))
    rolling = F.round(F.avg("rate").over(w.rowsBetween(-2, Window.currentRow)), 4)
    r = c.withColumn("rolling", rolling)
    flag = F.when((F.col("rolling") > 0) & (F.col("rate") > 2 * F.col("rolling")), F.lit(CHURN_SPIKE_FLAG))
    out = r.select("plan_tier", "month", F.col("new_subs").cast("bigint").alias("new_subs"),
                   F.col("growth").cast("double").alias("mom_new_sub_growth_pct"),
                   F.col("churned").cast("bigint").alias("churned"),
                   F.col("rate").cast("double").alias("monthly_churn_rate_pct"),
                   F.col("rolling").cast("double").alias("rolling_3m_avg_churn_pct"),
                   flag.alias("churn_flag"))
    if ordered:
        out = out.orderBy(F.col("plan_tier").asc_nulls_last(), "month")
    return out


# --------------------------------------------------------------------------- S5
def clean_accounts(entities: DataFrame) -> DataFrame:
    """Normalised name, e-mail domain, first token, name length, signup day number."""
    e = entities.where(F.col("company_name").isNotNull() & (F.trim(F.col("company_name")) != ""))
    name = normalize_name("company_name")
    return e.select(
        "customer_id", name.alias("name"), email_domain("contact_email").alias("domain"), "signup_date"
    ).select("*", first_token("name").alias("token"), F.length("name").alias("name_len"),
             F.datediff(F.col("signup_date"), F.lit("1970-01-01").cast("date")).alias("signup_day"))


def similar_names(entities: DataFrame, max_edits: int = 3, text: Column | None = None) -> DataFrame:
    """Pairs of different account names within ``max_edits`` edits, with the accounts that have each:
    name_a < name_b, distance, same_first_word, accounts_a, accounts_b.

    ``text``: another text of the cleaned accounts to compare. Accounts of one name are one class, so a pair
    of classes stands for all pairs of their accounts.
    """
    names = clean_accounts(entities).select((F.col("name") if text is None else text).alias("name"))
    held = names.where(F.col("name").isNotNull()).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    a = held.select(F.col("name").alias("name_a"), F.col("n").alias("accounts_a"))
    b = held.select(F.col("name").alias("name_b"), F.col("n").alias("accounts_b"))
    pairs = similar_texts(names, "name", max_edits).withColumnsRenamed({"text_a": "name_a", "text_b": "name_b"})
    return pairs.join(a, "name_a").join(b, "name_b").select(
        "name_a", "name_b", "distance", (first_token("name_a") == first_token("name_b")).alias("same_first_word"),
        "accounts_a", "accounts_b")


def duplicate_accounts(entities: DataFrame, ordered: bool = True, account_attrs: DataFrame | None = None,
                       max_edits: int | None = None) -> DataFrame:
    """Pairs of accounts with at least two of: same e-mail domain, similar name
    (same first token and length within 5), sign-ups within 7 days.

    With ``max_edits`` names are similar by the stricter rule that the report announces: same first
    token and an edit distance of at most ``max_edits``.

    Rather than enumerate every pair sharing a domain or a first token and
    score them, the three ways to reach a score of 2 are three band joins
    that only meet qualifying pairs; they are made disjoint so a plain
    UNION ALL needs no de-duplication shuffle.
    """
    acc = clean_accounts(entities)
    attrs = ["name", "domain", "signup_date", "token", "name_len", "signup_day"]
    extra = []
    if account_attrs is not None:  # per-account columns carried into the pairs as <col>_a / <col>_b
        extra = [c for c in account_attrs.columns if c != "customer_id"]
        # read by three joins, either side of each, and their key counts: written once (shared checkpoint folder)
        acc = cut_lineage(acc.join(account_attrs, "customer_id", "left"))
    spread = 5 if max_edits is None else max_edits

    def same_domain(a, b):
        return F.coalesce(a("domain") == b("domain"), F.lit(False))

    def similar_name(a, b):
        if max_edits is None:
            return (a("name") == b("name")) | ((a("token") == b("token")) & (F.abs(a("name_len") - b("name_len")) <= spread))
        return (a("token") == b("token")) & (F.levenshtein(a("name"), b("name"), max_edits) >= 0)

    def similar_signup(a, b):
        return F.coalesce(F.abs(a("signup_day") - b("signup_day")) <= 7, F.lit(False))

    rules = {"same_domain": same_domain, "similar_name": similar_name, "similar_signup": similar_signup}

    def pairs(block, band, width, known, extra_bands=(), where=None):
        """``known``: rules whose result the join itself settles."""
        def scored(a, b):
            found = {name: F.lit(known[name]) if name in known else rule(a, b).cast("int") for name, rule in rules.items()}
            score = found["same_domain"] + found["similar_name"] + found["similar_signup"]
            return found | {"match_score": score, "duplicate_confidence": F.when(score >= 3, DUPLICATE_LABELS[0]).when(
                score == 2, DUPLICATE_LABELS[1]).otherwise(DUPLICATE_LABELS[2])}

        return band_self_pairs(acc, "customer_id", block, band, width, attrs, extra_bands=extra_bands, own=extra, where=where,
                               shared=scored).drop(*block)

    dn = pairs(["domain", "token"], "name_len", spread, {"same_domain": 1, "similar_name": 1}, where=similar_name)  # domain & name
    ds = pairs(["domain"], "signup_day", 7, {"same_domain": 1, "similar_name": 0, "similar_signup": 1},
               where=lambda a, b: ~similar_name(a, b))                                                # domain & signup, not name
    ns = pairs(["token"], "signup_day", 7, {"same_domain": 0, "similar_name": 1, "similar_signup": 1}, [("name_len", spread)],
               lambda a, b: ~same_domain(a, b) & similar_name(a, b))                                  # name & signup, not domain
    cols = [F.col("customer_id_a").alias("cust_a_id"), F.col("customer_id_b").alias("cust_b_id"), "name_a", "name_b", "domain_a", "domain_b",
            F.col("signup_date_a").alias("signup_a"), F.col("signup_date_b").alias("signup_b"), *rules, "match_score",
            *[f"{c}_{side}" for c in extra for side in "ab"], "duplicate_confidence"]
    out = dn.select(*cols).unionByName(ds.select(*cols)).unionByName(ns.select(*cols))  # each of them scores 2 at least
    if ordered:
        out = out.orderBy(F.col("match_score").desc(), F.col("signup_a").asc_nulls_last(), "cust_a_id", "cust_b_id")
    return out


def member_summary(members: DataFrame) -> DataFrame:
    """Per account: distinct e-mails of its active members' member ids
    (``shared_member_emails``) and its set of distinct active member domains as bits (``doms``, ``doms_more``)."""
    active = members.where(F.col("is_active"))
    a_members = active.select("customer_id", "member_id").distinct()
    emails = members.select("member_id", "email").distinct()
    per_account_emails = (a_members.join(emails, "member_id").groupBy("customer_id")
                          .agg(F.count_distinct("email").alias("shared_member_emails")))
    dom = F.lower(F.split_part("email", F.lit("@"), F.lit(2)))
    used = active.select("customer_id", dom.alias("dom")).where(F.col("dom").isNotNull()).distinct()
    numbers = dense_numbers(used, "dom", "dom_no")
    dsets = bitsets(used.join(numbers, "dom"), ["customer_id"], "dom_no", "doms")
    return per_account_emails.join(dsets, "customer_id", "full")


def _member_evidence(p: DataFrame) -> DataFrame:
    return p.select("cust_a_id", "cust_b_id",
                    F.coalesce(F.col("shared_member_emails_a"), F.lit(0)).cast("bigint").alias("shared_member_emails"),
                    shared_values(("doms_a", "doms_more_a"), ("doms_b", "doms_more_b")).alias("shared_member_domains"))


def shared_member_domains(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Team-member evidence for any list of account pairs (``cust_a_id``, ``cust_b_id``).

    ``shared_member_emails``: distinct e-mails of the members of account A
    (what the original scoring step counts; B's members do not change it).
    ``shared_member_domains``: distinct e-mail domains that active members of
    both A and B use (the evidently intended signal).
    Both come from one per-account summary joined 1:1 onto each side of the pairs;
    a pair costs an AND of a few words instead of members x members rows.
    """
    acct = member_summary(members)
    a = acct.select(F.col("customer_id").alias("cust_a_id"), F.col("shared_member_emails").alias(
        "shared_member_emails_a"), F.col("doms").alias("doms_a"), F.col("doms_more").alias("doms_more_a"))
    b = acct.select(F.col("customer_id").alias("cust_b_id"), F.col("doms").alias("doms_b"), F.col("doms_more").alias("doms_more_b"))
    p = pairs.select("cust_a_id", "cust_b_id").join(a, "cust_a_id", "left").join(b, "cust_b_id", "left")
    return _member_evidence(p)


def duplicate_member_evidence(entities: DataFrame, members: DataFrame) -> DataFrame:
    """``shared_member_domains`` for the duplicate-account pairs, without joining the pair list:
    the per-account member summary is attached to the accounts before the pairs are
    generated, so each pair is born with both summaries (the pair list is the large side). The members, which the summary
    reads several times, are written once (shared checkpoint folder)."""
    members = cut_lineage(members.select("customer_id", "member_id", "email", "is_active"))
    pairs = duplicate_accounts(entities, ordered=False, account_attrs=member_summary(members))
    return _member_evidence(pairs)
