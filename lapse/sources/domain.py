"""Retention-domain tables derived, by Spark, from the stored TPC-H-like tables.

The workload's own inputs (subscriptions, plans, tickets, invoices, activity
logs, onboarding events, team members) are not shipped, so each domain table
is a deterministic view over the given tables. Everything here is lazy: a
query that only needs two columns of ``subscriptions`` only scans those
columns of ``orders``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.argmax import argmax_columns
from ..operators.latest import latest_per
from .tables import POSITION, read_table, with_position

# Fixed values of the view mapping.
PLAN_TIERS = {1: "enterprise", 2: "professional", 3: "starter", 4: "free", 5: "free"}
SUBSCRIPTION_STATUS = {"O": "active", "F": "cancelled", "P": "paused"}
INVOICE_STATUS = {"N": "paid", "R": "refunded", "A": "void"}
ACTIVITY_EVENT_TYPES = {"view": "feature_click", "click": "feature_click", "purchase": "report_generate"}
ONBOARDING_STEPS = {  # source event type -> (step, step_index)
    "signup": ("signup", 1),
    "view": ("first_login", 2),
    "click": ("workspace_created", 3),
    "error": ("first_project", 4),
    "purchase": ("invited_teammate", 5),
}
CANCELLED_SUBSCRIPTION_DAYS = 45
FEATURE_BUCKETS = 13
DUP_SIGNUP_EPOCH = "2024-01-01"
AS_OF = "2001-08-01"


def mapping(col: Column, table: dict, default: Column | None = None) -> Column:
    """CASE col WHEN k THEN v ... END from a small fixed dict."""
    expr = None
    for k, v in table.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(default) if default is not None else expr


def plan_id_of(priority: Column) -> Column:
    return F.substring(priority, 1, 1).try_cast("int")


class Domain:
    """Lazily built domain tables over a folder of stored tables."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.base, name)

    # ---------------------------------------------------------------- relational
    @cached_property
    def plans(self) -> DataFrame:
        """The plan dimension: at most 5 rows (plan ids 1..5) by construction.

        A partial aggregate over one column of ``orders``; nothing runs until a report does.
        """
        o = self.table("orders")
        pid = plan_id_of(F.col("o_orderpriority"))
        p = (o.select(pid.alias("plan_id"), "o_orderpriority")
             .where(F.col("plan_id").between(1, 5)).distinct()  # a few rows: the least text of each plan without sorting orders
             .groupBy("plan_id").agg(F.array_min(F.collect_set("o_orderpriority")).alias("plan_name")))
        return p.select(
            "plan_id", "plan_name",
            mapping(F.col("plan_id"), PLAN_TIERS).alias("plan_tier"),
            ((F.lit(6) - F.col("plan_id")) * 20).cast("decimal(12,2)").alias("monthly_price_usd"))

    @cached_property
    def subscriptions(self) -> DataFrame:
        o = self.table("orders")
        start = F.when(F.col("o_orderkey") % 211 != 5, F.to_date("o_orderdate"))  # some have no start date
        status = F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0), "trial").otherwise(
            mapping(F.col("o_orderstatus"), SUBSCRIPTION_STATUS))
        return o.select(
            F.col("o_orderkey").alias("subscription_id"),
            F.col("o_custkey").alias("customer_id"),
            plan_id_of(F.col("o_orderpriority")).alias("plan_id"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("mrr_usd"),
            status.alias("status"),
            start.alias("start_date"),
            F.when(F.col("o_orderstatus") == "F", F.date_add(start, CANCELLED_SUBSCRIPTION_DAYS)).alias("end_date"))

    @cached_property
    def latest_subscription(self) -> DataFrame:
        """Latest subscription of any status per customer (start_date DESC NULLS FIRST, id DESC)."""
        return latest_per(self.subscriptions, ["customer_id"], ["start_date", "subscription_id"], packed=True)

    def latest_subscription_of(self, *cols: str) -> DataFrame:
        """``latest_subscription`` carrying only ``cols``."""
        return latest_per(self.subscriptions, ["customer_id"], ["start_date", "subscription_id"],
                          columns=["customer_id", *cols], packed=True)

    @cached_property
    def customer_subscription_summary(self) -> DataFrame:
        """Per customer, in ONE combinable aggregate: first start date and the latest
        subscription's status / end date (DESC NULLS FIRST on start_date, then id)."""
        latest, outputs = argmax_columns(self.subscriptions, ["start_date", "subscription_id"], ["status", "end_date"])
        return self.subscriptions.groupBy("customer_id").agg(F.min("start_date").alias("signup_date"), *latest) \
            .select("customer_id", "signup_date", *outputs).withColumnsRenamed({"status": "latest_status", "end_date": "latest_end"})

    @cached_property
    def customers(self) -> DataFrame:
        c = self.table("customer")
        n = self.table("nation").select(F.col("n_nationkey"), F.col("n_name"))
        summary = self.customer_subscription_summary.select(
            "customer_id", "signup_date",
            F.when(F.col("latest_status") == "cancelled", F.col("latest_end")).alias("churn_date"))
        base = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
            F.col("c_custkey").alias("customer_id"),
            F.when(F.col("c_custkey") % 53 == 3, F.lit(None)).when(F.col("c_custkey") % 59 == 4, F.lit("  "))
             .when(F.col("c_custkey") % 61 == 5, F.lit("")).otherwise(F.col("c_name")).alias("company_name"),
            F.col("c_mktsegment").alias("industry"),
            F.when(F.col("c_acctbal") < 2500, "small").when(F.col("c_acctbal") < 5000, "medium")
             .when(F.col("c_acctbal") < 7500, "large").otherwise("enterprise").alias("company_size"),
            F.col("n_name").alias("country_code"))
        churned_at = F.col("churn_date").cast("timestamp_ntz")
        return (base.join(summary, "customer_id", "left")
                .select("customer_id", "company_name", "industry", "company_size", "country_code", "signup_date",
                        churned_at.isNull().alias("is_active"),
                        churned_at.alias("churned_at"),
                        F.when(churned_at.isNotNull(), F.lit("cancelled")).alias("churn_reason")))

    def _line_orders(self, *line_cols: str, where: Column | None = None) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", *line_cols)
        if where is not None:
            li = li.where(where)
        o = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return li.join(o, "l_orderkey")

    @cached_property
    def support_tickets(self) -> DataFrame:
        j = self._line_orders("l_linenumber", "l_shipdate", "l_returnflag", where=F.col("l_returnflag") == "R")
        return j.select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"),
                        F.col("l_linenumber").cast("string")).alias("ticket_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_shipdate").alias("created_at"))

    @cached_property
    def billing_invoices(self) -> DataFrame:
        j = self._line_orders("l_extendedprice", "l_discount", "l_returnflag")
        amount = F.round(F.col("l_extendedprice").cast("decimal(18,2)")
                         * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2).cast("decimal(18,2)")
        return j.select(F.col("o_custkey").alias("customer_id"),
                        mapping(F.col("l_returnflag"), INVOICE_STATUS).alias("status"),
                        amount.alias("amount_usd"))

    # ---------------------------------------------------------------- documents
    @cached_property
    def activity_logs(self) -> DataFrame:
        """Clean activity log (the output shape of M0)."""
        return self._activity(self.table("events"))

    @cached_property
    def stored_activity_logs(self) -> DataFrame:
        """The clean activity log with the events' places in the stored table."""
        return self._activity(with_position(self.table("events")), POSITION)

    @staticmethod
    def _activity(e: DataFrame, *carried: str) -> DataFrame:
        k = F.get_json_object("props", "$.k").try_cast("int")
        return e.select(
            "event_id",
            F.col("user_id").alias("member_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts"),
            mapping(F.col("event_type"), ACTIVITY_EVENT_TYPES, default=F.col("event_type")).alias("event_type"),
            F.when(F.col("event_id") % 41 == 7, F.lit("unknown")).when(F.col("event_id") % 43 != 8, F.concat(
                F.lit("f"), (k % FEATURE_BUCKETS).cast("string"))).alias("feature"),
            F.when(F.col("event_id") % 47 != 9, F.floor(F.col("value") * 24).cast("double")).alias("session_duration_sec"), *carried)

    @cached_property
    def raw_activity_logs(self) -> DataFrame:
        """The clean log re-encoded the way a document store holds it (FIXTURES §4).

        Ids move between three variant names and become strings, timestamps
        use four layouts, 2 % become orphans, 5 % are emitted twice, and a few
        carry junk timestamps, junk customer ids or text member ids. Deterministic by event_id.
        """
        a = self.activity_logs
        eid = F.col("event_id")
        variant = eid % 3
        cust = F.when(eid % 50 == 0, F.col("customer_id") + 10_000_000).otherwise(F.col("customer_id")).cast("string")
        cust = F.when(eid % 89 == 7, F.lit("x")).otherwise(cust)
        mem = F.col("member_id").cast("string")
        mem = F.when(eid % 83 == 9, F.concat(F.lit("m-"), mem)).otherwise(mem)  # some ids are texts
        ts = F.col("ts")
        fmt = eid % 4
        ts_text = (F.when(fmt == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
                   .when(fmt == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
                   .when(fmt == 2, F.date_format(ts, "MM/dd/yyyy HH:mm:ss"))
                   .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")))
        ts_text = F.when(eid % 97 == 5, F.lit("junk")).otherwise(ts_text)
        copies = F.when(eid % 20 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return a.select(
            "event_id",
            F.when(variant == 0, mem).alias("member_id"),
            F.when(variant == 1, mem).alias("userId"),
            F.when(variant == 2, mem).alias("userID_"),
            F.when(variant == 0, cust).alias("customer_id"),
            F.when(variant == 1, cust).alias("customerId"),
            F.when(variant == 2, cust).alias("customerID_"),
            ts_text.alias("timestamp"),
            "event_type", "feature", "session_duration_sec",
            F.explode(copies).alias("copy"))

    @cached_property
    def activity_dump(self) -> DataFrame:
        """``raw_activity_logs`` as the lines of a document store's dump: a field's type changes from document to document."""
        r, eid = self.raw_activity_logs, F.col("event_id")

        def quoted(c: Column) -> Column:
            return F.concat(F.lit('"'), c, F.lit('"'))

        def number(c: Column) -> Column:
            """As a number, a text, the store's notation or a number with a fraction; what is no number is a text."""
            whole = c.rlike("^[0-9]+$")
            return F.when(whole & (eid % 5 == 0), c).when(whole & (eid % 5 == 1), F.concat(F.lit('{"$numberLong":"'), c, F.lit('"}'))).when(
                whole & (eid % 5 == 2), F.concat(c, F.lit(".0"))).otherwise(quoted(c))

        ts = F.col("timestamp")
        millis = F.unix_millis(F.to_timestamp(ts, "yyyy-MM-dd'T'HH:mm:ssX")).cast("string")
        at = F.when(ts.endswith("Z") & (eid % 3 == 0), F.concat(F.lit('{"$date":{"$numberLong":"'), millis, F.lit('"}}'))).when(
            ts.contains("T") & (eid % 3 != 1), F.concat(F.lit('{"$date":"'), ts, F.lit('"}'))).when(ts == "junk", F.lit("12345")).otherwise(quoted(ts))
        parts = [(n, number(F.col(n))) for n in ("member_id", "userId", "userID_", "customer_id", "customerId", "customerID_")]
        parts += [("timestamp", at), ("event_type", quoted(F.col("event_type"))), ("feature", F.coalesce(quoted(F.col("feature")), F.lit("null"))),
                  ("session_duration_sec", number(F.col("session_duration_sec").cast("bigint").cast("string")))]
        fields = [F.concat(F.lit(f'"{n}":'), c) for n, c in parts]  # NULL: the document lacks the field
        return r.select(F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")).alias("value"))

    @cached_property
    def onboarding_events(self) -> DataFrame:
        e = self.table("events")
        step = mapping(F.col("event_type"), {k: v[0] for k, v in ONBOARDING_STEPS.items()})
        idx = mapping(F.col("event_type"), {k: v[1] for k, v in ONBOARDING_STEPS.items()})
        return e.select(
            F.col("user_id").alias("member_id"),
            F.col("user_id").alias("customer_id"),
            step.alias("step"),
            idx.cast("int").alias("step_index"),
            (F.col("value") >= F.lit(60) * (idx - 1)).alias("completed"),
            F.col("ts").alias("timestamp"))

    # ---------------------------------------------------------------- duplicates
    @cached_property
    def duplicate_entities(self) -> DataFrame:
        """Account-like entities for duplicate detection (from part)."""
        p = self.table("part")
        email = F.concat(F.lit("u"), F.col("p_partkey").cast("string"), F.lit("+tag@"),
                         F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))), F.lit(".com"))
        return p.select(
            F.col("p_partkey").alias("customer_id"),
            F.col("p_name").alias("company_name"),
            email.alias("contact_email"),
            F.date_add(F.lit(DUP_SIGNUP_EPOCH).cast("date"), F.col("p_size")).alias("signup_date"))

    @cached_property
    def team_members(self) -> DataFrame:
        li = self.table("lineitem").select("l_partkey", "l_suppkey").distinct()
        email = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"), F.lit("@d"),
                         (F.col("l_suppkey") % 10).cast("string"), F.lit(".com"))
        return li.select(F.col("l_suppkey").alias("member_id"), F.col("l_partkey").alias("customer_id"),
                         email.alias("email"), (F.col("l_suppkey") % 9 != 2).alias("is_active"))
