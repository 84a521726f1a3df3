"""Activity-log and onboarding analytics (the document-store pipelines).

Every array the document pipelines build only to count, filter or index into
is replaced by a conditional aggregate or a pre-aggregated order statistic:
state per group stays bounded and combines map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import safe_bigint, safe_double
from ..functions.timeparse import iso_week_key, parse_mixed_timestamp
from ..operators.latest import earliest_per
from ..operators.order_stats import grouped_quantiles
from ..operators.quantiles import floor_index_quantiles
from ..sources.tables import POSITION

# Id variant names, funnel steps, score weights and bands.
MEMBER_ID_VARIANTS = ("member_id", "userId", "userID", "userID_", "memberId")
CUSTOMER_ID_VARIANTS = ("customer_id", "customerId", "customerID", "customerID_")
FUNNEL_STEPS = ("signup", "first_login", "workspace_created", "first_project", "invited_teammate")
DROPOFF_NAMES = ("dropoff_from_prev_pct", "dropoff_from_signup_pct", "dropoff_from_first_login_pct",
                 "dropoff_from_workspace_pct", "dropoff_from_first_project_pct")
SCORE_WEIGHTS = {"total_events": 3, "feature_clicks": 5, "report_generates": 4,
                 "distinct_features_used": 10, "days_active": 2}
LONG_SESSION_SEC = 1800
LONG_SESSION_BONUS = 10
PRIORITY_BANDS = ((200, "HIGH"), (100, "MEDIUM"))
PRIORITY_DEFAULT = "LOW"
RETURN_WINDOW_DAYS = 7


# --------------------------------------------------------------------------- M0
def normalize_events(raw: DataFrame, member_variants: Sequence[str] = MEMBER_ID_VARIANTS,
                     customer_variants: Sequence[str] = CUSTOMER_ID_VARIANTS, need_customer: bool = True,
                     member_text: bool = False) -> DataFrame:
    """Unify id variants (first non-null wins), parse mixed timestamps to UTC, drop rows without a
    member id or a customer id (unless ``need_customer`` is off) or with unparsable times.

    Customer ids are integers by a safe cast. A member id may be anything: ``member_id`` is its integer, or
    null where it is none, and with ``member_text`` a column ``member_key`` carries it as text (5, "5" and "5.0" are
    one member) and rows of any member id are kept; see :func:`member_events`. Durations are numbers by a safe cast."""
    mv = [c for c in member_variants if c in raw.columns]
    cv = [c for c in customer_variants if c in raw.columns]

    def first_of(names: Sequence[str]) -> tuple[Column, Column]:
        """The first non-null variant as text and as an integer."""
        if not names:
            return F.lit(None).cast("string"), F.lit(None).cast("bigint")
        kinds = {c: raw.schema[c].dataType for c in names}
        number, seen = F.lit(None).cast("bigint"), F.lit(True)
        for c in names:  # each variant is cast by its own type
            number = F.coalesce(number, F.when(seen, safe_bigint(c, dtype=kinds[c])))
            seen = seen & F.col(c).isNull()
        return F.coalesce(*[F.col(c).cast("string") for c in names]), number

    member_key, member = first_of(mv)
    _, customer = first_of(cv)
    ts_src = "timestamp" if "timestamp" in raw.columns else "ts"
    ts = parse_mixed_timestamp(F.col(ts_src)) if dict(raw.dtypes)[ts_src] == "string" \
        else F.col(ts_src).cast("timestamp_ntz")
    keep: list[str | Column] = [c for c in ("event_type", "feature") if c in raw.columns]
    if "session_duration_sec" in raw.columns:
        keep.append(safe_double("session_duration_sec", raw.schema["session_duration_sec"].dataType).alias("session_duration_sec"))
    if member_text:
        keep.append("member_key")
    out = raw.withColumn("member_key", F.coalesce(member.cast("string"), member_key)).select(
        member.alias("member_id"), customer.alias("customer_id"), ts.alias("ts"), F.col("member_key").alias("_key"), *keep)
    named = F.col("_key").isNotNull() if member_text else F.col("member_id").isNotNull()
    if need_customer:
        named = named & F.col("customer_id").isNotNull()
    return out.where(named & F.col("ts").isNotNull()).drop("_key")


def member_events(raw: DataFrame, need_customer: bool = True) -> DataFrame:
    """Normalised events of every member that has an id of any kind; reports on members group by ``member_key``."""
    return normalize_events(raw, need_customer=need_customer, member_text=True)


def member_column(events: DataFrame) -> str:
    """What tells members apart: their key, where member ids may be texts, or else their integer."""
    return "member_key" if "member_key" in events.columns else "member_id"


# --------------------------------------------------------------------------- tiers
def mod_tier(customer_id: Column) -> Column:
    """Placeholder tier: customer_id mod 4 with <= tests (negative remainders are 'free')."""
    m = customer_id % 4
    return (F.when(m <= 0, "free").when(m <= 1, "starter").when(m <= 2, "professional").otherwise("enterprise"))


def current_tiers(latest_subscription: DataFrame, plans: DataFrame) -> DataFrame:
    """customer_id -> plan_tier of the latest subscription (the real cross-store lookup)."""
    return latest_subscription.select("customer_id", "plan_id").join(
        plans.select("plan_id", "plan_tier"), "plan_id").select("customer_id", "plan_tier")


# --------------------------------------------------------------------------- M1
def session_cadence(logs: DataFrame, tiers: DataFrame | None = None) -> DataFrame:
    """Sessions per user-week and per-user duration quartiles, averaged per tier.

    Every event is a session; null durations do not enter the quartiles. Quartiles
    use the floor-index rule per user, then are averaged per tier. Without a
    ``tiers`` table the placeholder ``customer_id mod 4`` tier is used.
    """
    keys = ["customer_id", member_column(logs)]
    # group on the ISO (week-year, week) integers; the display string is not needed here
    ev = logs.select(*keys, F.extract(F.lit("YEAROFWEEK"), F.col("ts")).alias("wy"),
                     F.weekofyear("ts").alias("wk"), "session_duration_sec")
    per_user = (ev.groupBy(*keys, "wy", "wk").agg(F.count(F.lit(1)).alias("n"))
                .groupBy(*keys).agg(F.avg("n").alias("avg_sessions")))
    q = floor_index_quantiles(ev, keys, "session_duration_sec", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    users = per_user.join(q, keys, "left")
    if tiers is None:
        users = users.withColumn("tier", mod_tier(F.col("customer_id")))
    else:
        users = users.join(tiers.withColumnRenamed("plan_tier", "tier"), "customer_id", "left")
    return users.groupBy("tier").agg(
        F.count(F.lit(1)).alias("user_count"),
        # exact decimal mean: a double sum's order could tip a half-even tie either way
        F.bround(F.avg(F.col("avg_sessions").cast("decimal(38,10)")), 2).cast("double").alias("avg_sessions_per_week"),
        F.bround(F.avg("p25"), 0).alias("avg_p25_session_duration_sec"),
        F.bround(F.avg("p50"), 0).alias("avg_p50_session_duration_sec"),
        F.bround(F.avg("p75"), 0).alias("avg_p75_session_duration_sec")).orderBy("tier")


# --------------------------------------------------------------------------- M2
def feature_first_use(logs: DataFrame) -> DataFrame:
    """(member_id, feature, first_use, returned): returned = another use in (first, first + 7 days]."""
    fc = logs.withColumn("member_id", F.col(member_column(logs))).where((F.col("event_type") == "feature_click")
                    & (F.coalesce(F.col("feature"), F.lit("unknown")) != "unknown")
                    & F.col("member_id").isNotNull() & F.col("ts").isNotNull()) \
        .select("member_id", "feature", "ts")
    firsts = fc.groupBy("member_id", "feature").agg(F.min("ts").alias("first_use"))
    horizon = F.make_dt_interval(F.lit(RETURN_WINDOW_DAYS))
    # only uses within [first, first + 7 days] matter: join on a 7-day bucket as well,
    # each first use repeated for the (at most 2) buckets its window touches, so the
    # join meets that neighbourhood only and a long history is split by time
    day = lambda c: F.unix_date(F.to_date(c))
    b = RETURN_WINDOW_DAYS
    firsts_b = firsts.select("*", F.explode(F.sequence(F.floor(day(F.col("first_use")) / b),
                                                       F.floor(day(F.col("first_use") + horizon) / b))).alias("_tb"))
    fc_b = fc.select("*", F.floor(day(F.col("ts")) / b).alias("_tb"))
    near = fc_b.join(firsts_b, ["member_id", "feature", "_tb"]) \
        .where((F.col("ts") >= F.col("first_use")) & (F.col("ts") <= F.col("first_use") + horizon))
    back = F.col("ts") > F.col("first_use")  # the first use itself keeps every key present
    return near.groupBy("member_id", "feature").agg(
        F.min("first_use").alias("first_use"), F.max(back.cast("int")).alias("returned"))


def feature_retention(logs: DataFrame) -> DataFrame:
    """Per feature: first-use 'DAU' (mean and peak over days with first uses),
    first users, users returning within 7 days, and the return rate (half-even)."""
    fu = feature_first_use(logs)
    daily = fu.groupBy("feature", F.to_date("first_use").alias("day")).agg(
        F.count(F.lit(1)).alias("dau"), F.sum("returned").alias("retained"))
    f = daily.groupBy("feature").agg(
        F.avg("dau").alias("avg_dau"), F.max("dau").alias("peak_dau"),
        F.sum("dau").alias("first_users"), F.sum("retained").alias("retained"))
    rate = F.bround(F.col("retained") / F.greatest(F.col("first_users"), F.lit(1)) * 100, 2)
    return f.select("feature", F.bround("avg_dau", 1).alias("avg_dau"), F.col("peak_dau").cast("bigint"),
                    F.col("first_users").cast("bigint").alias("total_unique_first_users"),
                    F.col("retained").cast("bigint").alias("retained_within_7d"),
                    rate.alias("retention_rate_7d_pct")).orderBy(F.col("retention_rate_7d_pct").desc(), "feature")


# --------------------------------------------------------------------------- M3
def funnel_counts(onboarding: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """One row: users that completed each step (steps are independent, no order enforced).

    Rows without a member id form one pseudo-user, as grouping on a missing id does.
    """
    member = F.coalesce(*[F.col(c) for c in MEMBER_ID_VARIANTS if c in onboarding.columns])
    done = onboarding.where(F.col("completed") & F.col("step").isin(*steps)).select(
        member.alias("member"), "step")
    per_user = done.groupBy("member").agg(*[F.max((F.col("step") == s).cast("int")).alias(s) for s in steps])
    return per_user.agg(F.count(F.lit(1)).alias("total_users"),
                        *[F.coalesce(F.sum(s), F.lit(0)).cast("bigint").alias(s) for s in steps])


def _dropoff(cur: Column, prev: Column) -> Column:
    return F.bround((F.lit(1) - cur / F.greatest(prev, F.lit(1))) * 100, 2)


def onboarding_funnel(onboarding: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """Long form: step, step_index, users, dropoff_pct (from the previous step)."""
    c = funnel_counts(onboarding, steps)
    rows = []
    for i, s in enumerate(steps):
        drop = F.lit(0.0) if i == 0 else _dropoff(F.col(s), F.col(steps[i - 1]))
        rows.append(F.struct(F.lit(s).alias("step"), F.lit(i + 1).alias("step_index"),
                             F.col(s).alias("users"), drop.cast("double").alias("dropoff_pct")))
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def onboarding_funnel_nested(onboarding: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """The report's nested shape: one row, ``funnel.<step>.{users, dropoff_from_<prev>_pct}``."""
    c = funnel_counts(onboarding, steps)
    parts = []
    for i, s in enumerate(steps):
        drop = F.lit(0) if i == 0 else _dropoff(F.col(s), F.col(steps[i - 1]))
        parts.append(F.struct(F.col(s).alias("users"), drop.alias(DROPOFF_NAMES[i])).alias(s))
    return c.select(F.struct(*parts).alias("funnel"))


def step_gap_median(onboarding: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """Median seconds between consecutive steps, over members who completed both."""
    member = F.coalesce(*[F.col(c) for c in MEMBER_ID_VARIANTS if c in onboarding.columns])
    at = parse_mixed_timestamp(F.col("timestamp")) if dict(onboarding.dtypes)["timestamp"] == "string" \
        else F.col("timestamp").cast("timestamp_ntz")
    done = onboarding.where(F.col("completed") & F.col("step").isin(*steps)).select(
        member.alias("member"), "step", at.alias("t"))
    firsts = done.groupBy("member").agg(*[F.min(F.when(F.col("step") == s, F.col("t"))).alias(s) for s in steps])
    gaps = []
    for i in range(1, len(steps)):
        a, b = steps[i - 1], steps[i]
        gap = F.timestamp_diff("MICROSECOND", F.col(a), F.col(b)) / F.lit(1e6)
        gaps.append(F.struct(F.lit(a).alias("from_step"), F.lit(b).alias("to_step"), gap.alias("gap_sec")))
    long = firsts.select(F.explode(F.array(*gaps)).alias("g")).select("g.*").where(F.col("gap_sec").isNotNull())
    medians = grouped_quantiles(long, ["from_step", "to_step"], "gap_sec", {"median_gap_sec": 0.5}, count_col="users_with_both")
    # every consecutive pair is reported, without users with a NULL median
    pairs = F.array(*[F.struct(F.lit(i).alias("nth"), F.lit(a).alias("from_step"), F.lit(b).alias("to_step"))
                      for i, (a, b) in enumerate(zip(steps, steps[1:]))])
    every = onboarding.sparkSession.range(1).select(F.explode(pairs).alias("p")).select("p.*")
    return every.join(medians, ["from_step", "to_step"], "left").orderBy("nth").select(
        "from_step", "to_step", F.coalesce("users_with_both", F.lit(0)).cast("bigint").alias("users_with_both"), "median_gap_sec")


# --------------------------------------------------------------------------- M4
def engagement_scores(logs: DataFrame, keys: Sequence[str] = ("customer_id", "member_id")) -> DataFrame:
    """Counts, score and priority per key; where member ids may be texts, ``member_id`` is the member's key."""
    keys = list(keys)
    ev = logs.withColumn("member_id", F.col(member_column(logs))).where(F.col("customer_id").isNotNull() & F.col("member_id").isNotNull() & F.col("ts").isNotNull())
    g = ev.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("event_type") == "feature_click").alias("feature_clicks"),
        F.count_if(F.col("event_type") == "report_generate").alias("report_generates"),
        F.count_distinct("feature").alias("distinct_features_used"),
        F.coalesce(F.max(F.col("session_duration_sec") >= LONG_SESSION_SEC), F.lit(False)).alias("has_long_session"),
        F.count_distinct(F.to_date("ts")).alias("days_active"))
    score = sum((F.col(c) * w for c, w in SCORE_WEIGHTS.items()), F.lit(0)) + \
        F.when(F.col("has_long_session"), LONG_SESSION_BONUS).otherwise(0)
    prio = F.when(score >= PRIORITY_BANDS[0][0], PRIORITY_BANDS[0][1]) \
        .when(score >= PRIORITY_BANDS[1][0], PRIORITY_BANDS[1][1]).otherwise(PRIORITY_DEFAULT)
    return g.select(*keys, *[F.col(c).cast("bigint").alias(c) for c in
                             ("total_events", "feature_clicks", "report_generates", "distinct_features_used",
                              "days_active")],
                    "has_long_session", score.cast("bigint").alias("engagement_score"), prio.alias("upsell_priority"))


def upsell_candidates(logs: DataFrame, k: int = 20, tiers: DataFrame | None = None,
                      tier: str | None = None) -> DataFrame:
    """Top-``k`` members by engagement score (ties by customer_id, member_id).

    ``tier`` restricts to customers whose current tier matches (needs ``tiers``);
    off by default. The top-k is a bounded TakeOrderedAndProject, not a sort.
    """
    if tier is not None:
        if tiers is None:
            raise ValueError("tier filter needs a tiers table")
        ids = tiers.where(F.col("plan_tier") == tier).select("customer_id")
        logs = logs.join(ids, "customer_id", "left_semi")
    s = engagement_scores(logs)
    number = F.col("member_id") if dict(s.dtypes)["member_id"] != "string" else safe_bigint("member_id")
    return s.orderBy(F.col("engagement_score").desc(), "customer_id", number.asc_nulls_last(), "member_id").limit(k)


def weekly_engagement_bands(logs: DataFrame) -> DataFrame:
    """Score per (member, ISO week) and its priority band counts (band thresholds check)."""
    ev = logs.withColumn("week", iso_week_key("ts"))
    s = engagement_scores(ev, keys=("customer_id", "member_id", "week"))
    return s.groupBy("upsell_priority").agg(F.count(F.lit(1)).alias("members_weeks"),
                                            F.min("engagement_score").alias("min_score"),
                                            F.max("engagement_score").alias("max_score"))


# --------------------------------------------------------------------------- P2
def drop_orphans(events: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Events whose customer exists (left semi join)."""
    return events.join(customers.select(key), key, "left_semi")


def orphan_audit(events: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """One row: rows_before, rows_after, dropped, dropped_pct (one pass, no second scan)."""
    ids = customers.select(key).distinct().withColumn("_known", F.lit(True))
    j = events.select(key).join(ids, key, "left")
    return j.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(F.col("_known")).alias("rows_after")) \
        .select("rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("dropped"),
                F.round(F.try_divide((F.col("rows_before") - F.col("rows_after")) * 100.0, F.col("rows_before")), 1)
                .alias("dropped_pct"))


def dedupe_events(events: DataFrame, subset: Sequence[str] = ("customer_id", "member_id", "feature", "ts"),
                  order: Sequence[str] | None = None) -> DataFrame:
    """One row per ``subset``; among copies the smallest ``order`` tuple is kept
    (default: the remaining columns), so the survivor is deterministic."""
    subset = list(subset)
    rest = [c for c in events.columns if c not in subset]
    return earliest_per(events, subset, list(order or rest)).select(*events.columns)


def keep_first(events: DataFrame, subset: Sequence[str]) -> DataFrame:
    """One row per ``subset``: the one that comes first in the input, whatever it holds (NULLs are values of a subset).

    ``events`` carries its rows' places (:func:`lapse.sources.tables.with_position`); the result does not.
    """
    return earliest_per(events, list(subset), [POSITION]).select(*[c for c in events.columns if c != POSITION])
