"""The domain views as DuckDB SQL, for the independent oracle side of the checks.

Same mapping as :mod:`lapse.sources.domain`, written directly in SQL over
the stored tables (``orders``, ``lineitem``, ``customer``, ...). A query's
oracle text is ``with_views(body, needed_views)``: the views it needs (and
their dependencies) become CTEs in front of ``body``.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "plans": ((), """
        SELECT plan_id, plan_name,
               CASE plan_id WHEN 1 THEN 'enterprise' WHEN 2 THEN 'professional' WHEN 3 THEN 'starter'
                            WHEN 4 THEN 'free' WHEN 5 THEN 'free' END AS plan_tier,
               CAST((6 - plan_id) * 20 AS DECIMAL(12,2)) AS monthly_price_usd
        FROM (SELECT TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS plan_id,
                     min(o_orderpriority) AS plan_name
              FROM orders GROUP BY 1) q
        WHERE plan_id BETWEEN 1 AND 5"""),
    "subscriptions": ((), """
        SELECT o_orderkey AS subscription_id, o_custkey AS customer_id,
               TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS plan_id,
               CAST(o_totalprice AS DECIMAL(12,2)) AS mrr_usd,
               CASE WHEN o_orderstatus = 'O' THEN 'active' WHEN o_orderstatus = 'F' THEN 'cancelled'
                    WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'trial' WHEN o_orderstatus = 'P' THEN 'paused' END AS status,
               CASE WHEN o_orderkey % 211 <> 5 THEN CAST(o_orderdate AS DATE) END AS start_date,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 211 <> 5 THEN CAST(o_orderdate AS DATE) + 45 END AS end_date
        FROM orders"""),
    "latest_sub": (("subscriptions",), """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id
                                         ORDER BY start_date DESC NULLS FIRST, subscription_id DESC) AS rn
            FROM subscriptions) z
        WHERE rn = 1"""),
    "customers": (("subscriptions", "latest_sub"), """
        SELECT c.c_custkey AS customer_id, CASE WHEN c.c_custkey % 53 = 3 THEN NULL WHEN c.c_custkey % 59 = 4 THEN '  '
                    WHEN c.c_custkey % 61 = 5 THEN '' ELSE c.c_name END AS company_name, c.c_mktsegment AS industry,
               CASE WHEN c.c_acctbal < 2500 THEN 'small' WHEN c.c_acctbal < 5000 THEN 'medium'
                    WHEN c.c_acctbal < 7500 THEN 'large' ELSE 'enterprise' END AS company_size,
               n.n_name AS country_code,
               f.signup_date,
               (CASE WHEN ls.status = 'cancelled' THEN ls.end_date END) IS NULL AS is_active,
               CASE WHEN ls.status = 'cancelled' THEN CAST(ls.end_date AS TIMESTAMP) END AS churned_at,
               CASE WHEN ls.status = 'cancelled' AND ls.end_date IS NOT NULL THEN 'cancelled' END AS churn_reason
        FROM customer c
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
        LEFT JOIN (SELECT customer_id, min(start_date) AS signup_date FROM subscriptions GROUP BY 1) f
               ON f.customer_id = c.c_custkey
        LEFT JOIN latest_sub ls ON ls.customer_id = c.c_custkey"""),
    "support_tickets": ((), """
        SELECT concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR)) AS ticket_id,
               o.o_custkey AS customer_id, l.l_shipdate AS created_at
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
        WHERE l.l_returnflag = 'R'"""),
    "billing_invoices": ((), """
        SELECT o.o_custkey AS customer_id,
               CASE l.l_returnflag WHEN 'N' THEN 'paid' WHEN 'R' THEN 'refunded' WHEN 'A' THEN 'void' END AS status,
               CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2)
                    AS DECIMAL(18,2)) AS amount_usd
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"""),
    "activity_logs": ((), """
        SELECT event_id, user_id AS member_id, user_id AS customer_id, ts,
               CASE WHEN event_type IN ('view', 'click') THEN 'feature_click'
                    WHEN event_type = 'purchase' THEN 'report_generate' ELSE event_type END AS event_type,
               CASE WHEN event_id % 41 = 7 THEN 'unknown' WHEN event_id % 43 <> 8
                    THEN 'f' || CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 13 AS VARCHAR) END AS feature,
               CASE WHEN event_id % 47 <> 9 THEN CAST(floor(value * 24) AS DOUBLE) END AS session_duration_sec
        FROM events"""),
    "clean_raw_logs": (("activity_logs",), """
        SELECT a.member_id,
               CASE WHEN a.event_id % 50 = 0 THEN a.customer_id + 10000000 ELSE a.customer_id END AS customer_id,
               CASE WHEN a.event_id % 4 = 3 THEN a.ts ELSE date_trunc('second', a.ts) END AS ts,
               a.event_type, a.feature, a.session_duration_sec, a.event_id
        FROM activity_logs a
        JOIN (VALUES (1), (2)) c(copy) ON c.copy = 1 OR a.event_id % 20 = 1
        WHERE a.event_id % 97 <> 5 AND a.event_id % 89 <> 7 AND a.event_id % 83 <> 9"""),
    "member_raw_logs": (("activity_logs",), """
        SELECT CASE WHEN a.event_id % 83 = 9 THEN 'm-' ELSE '' END || a.member_id AS member_id,
               CASE WHEN a.event_id % 50 = 0 THEN a.customer_id + 10000000 ELSE a.customer_id END AS customer_id,
               CASE WHEN a.event_id % 4 = 3 THEN a.ts ELSE date_trunc('second', a.ts) END AS ts,
               a.event_type, a.feature, a.session_duration_sec, a.event_id
        FROM activity_logs a
        JOIN (VALUES (1), (2)) c(copy) ON c.copy = 1 OR a.event_id % 20 = 1
        WHERE a.event_id % 97 <> 5 AND a.event_id % 89 <> 7"""),
    "raw_logs_any_customer": (("activity_logs",), """
        SELECT CASE WHEN a.event_id % 83 = 9 THEN 'm-' ELSE '' END || a.member_id AS member_id,
               CASE WHEN a.event_id % 4 = 3 THEN a.ts ELSE date_trunc('second', a.ts) END AS ts,
               a.event_type, a.feature, a.session_duration_sec
        FROM activity_logs a
        JOIN (VALUES (1), (2)) c(copy) ON c.copy = 1 OR a.event_id % 20 = 1
        WHERE a.event_id % 97 <> 5"""),
    "onboarding_events": ((), """
        SELECT user_id AS member_id, user_id AS customer_id,
               CASE event_type WHEN 'signup' THEN 'signup' WHEN 'view' THEN 'first_login'
                    WHEN 'click' THEN 'workspace_created' WHEN 'error' THEN 'first_project'
                    WHEN 'purchase' THEN 'invited_teammate' END AS step,
               CAST(CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
                    WHEN 'error' THEN 4 WHEN 'purchase' THEN 5 END AS INTEGER) AS step_index,
               value >= 60 * (CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
                    WHEN 'error' THEN 4 WHEN 'purchase' THEN 5 END - 1) AS completed,
               ts AS "timestamp"
        FROM events"""),
    "dup_entities": ((), """
        SELECT p_partkey AS customer_id, p_name AS company_name,
               'u' || CAST(p_partkey AS VARCHAR) || '+tag@' || lower(replace(p_brand, '#', '')) || '.com'
                   AS contact_email,
               DATE '2024-01-01' + p_size AS signup_date
        FROM part"""),
    "team_members": ((), """
        SELECT l_suppkey AS member_id, l_partkey AS customer_id,
               's' || CAST(l_suppkey AS VARCHAR) || '@d' || CAST(l_suppkey % 10 AS VARCHAR) || '.com' AS email,
               l_suppkey % 9 <> 2 AS is_active
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) d"""),
}


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in VIEWS[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(body: str, views, extra_ctes: str = "") -> str:
    """``WITH <views...>[, extra] <body>``; ``extra_ctes`` are more 'name AS (...)' items."""
    parts = [f"{n} AS ({VIEWS[n][1]}\n)" for n in _order(views)]
    if extra_ctes.strip():
        parts.append(extra_ctes.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + body
