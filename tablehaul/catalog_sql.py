"""The catalogue views of ``catalog`` as SQL common table expressions."""

from __future__ import annotations

import re

from tablehaul import catalog as cat
from tablehaul import fixed_values as fv


def _pick(values, index):
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{index} + 1]"


def _by_user(values):
    return _pick(values, f"user_id % {len(values)}")


VIEWS: dict[str, str] = {
    "customer_v": """
        SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal,
               c_mktsegment FROM customer""",
    "part_v": """
        SELECT p_partkey, p_name, p_brand, p_type, p_size,
               CAST(p_retailprice AS DECIMAL(10,2)) AS p_retailprice FROM part""",
    "orders_v": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
               CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders""",
    "lineitem_v": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               CAST(l_quantity AS INTEGER) AS l_quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice,
               CAST(l_discount AS DECIMAL(12,2)) AS l_discount,
               CAST(l_tax AS DECIMAL(12,2)) AS l_tax, l_returnflag, l_linestatus,
               CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""",
    "orders_aug": f"""
        SELECT *, {_pick(fv.PAYMENT_METHODS, 'o_orderkey % 4')} AS payment_method,
               {_pick(fv.CUSTOMER_SEGMENTS, 'o_orderkey % 3')} AS customer_segment,
               {_pick(fv.ORDER_SOURCES, 'o_orderkey % 2')} AS order_source,
               o_orderkey % {fv.EXPEDITED_EVERY} = 0 AS shipping_expedited FROM orders_v""",
    "lineitem_aug": f"""
        SELECT *, {_pick(cat.SHIP_MODES, '(l_linenumber - 1)')} AS l_shipmode,
               (CAST(l_shipdate AS TIMESTAMP) AT TIME ZONE '{fv.DELIVERY_ZONE}')
                 AT TIME ZONE 'UTC' AS delivery_at FROM lineitem_v""",
    "addresses": f"""
        SELECT c_custkey, addr_offset, (c_custkey + addr_offset) || '{fv.STREET_SUFFIX}' AS line,
               {_pick(fv.CITIES, '((c_custkey + addr_offset) % 5)')} AS city,
               {_pick(fv.COUNTRIES, '((c_custkey + addr_offset) % 5)')} AS country
        FROM (SELECT c_custkey, unnest(range(0, c_custkey % 3 + 1)) AS addr_offset FROM customer)""",
    "daily_order_summary": """
        SELECT o_orderdate AS order_day, o_orderpriority, count(*) AS order_count,
               sum(o_totalprice) AS daily_revenue FROM orders_v GROUP BY ALL""",
    "ec_users": f"""
        SELECT c_custkey AS user_id, any_value(c_mktsegment) AS segment,
               {_pick(cat.USER_COUNTRIES, 'any_value(c_nationkey) % 5')} AS country_code,
               coalesce(min(o_orderdate), DATE '1995-01-01') AS registration_date,
               CAST(coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 0)
                    AS DECIMAL(38,2)) AS lifetime_value
        FROM customer LEFT JOIN orders_v ON o_custkey = c_custkey GROUP BY c_custkey""",
    "ec_products": """
        SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
               p_brand AS subcategory, p_retailprice AS price FROM part_v""",
    "ec_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                    ELSE 'cancelled' END AS status,
               o_totalprice AS total_amount, o_orderdate AS order_day,
               CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS created_at
        FROM orders_v""",
    "ec_order_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity,
               l_extendedprice AS unit_price,
               CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_pct FROM lineitem_v""",
    "events_v": """
        SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(12,2)) AS value, props,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "ec_events": """
        SELECT event_id, user_id, k,
               CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
                    ELSE event_type END AS event_type, ts AS created_at,
               '{"label":"item_' || k || '","value":' || value || '}' AS properties
        FROM events_v""",
    "ec_ad_impressions": """
        SELECT event_id AS impression_id, user_id % 20 AS campaign_id, event_type AS placement,
               k < 5 AS clicked, k < 2 AS converted,
               CAST(k * 90 + 1000 AS BIGINT) AS cost_micros, ts AS impression_at FROM events_v""",
    "user_days": """
        SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS started_at, max(ts) AS ended_at,
               count(*) AS page_count, first(event_type ORDER BY ts, event_id) AS first_type,
               last(event_type ORDER BY ts, event_id) AS last_type,
               user_id || '-' || strftime(CAST(ts AS DATE), '%Y%m%d') AS session_id,
               datesub('second', min(ts), max(ts)) AS duration_seconds
        FROM events_v GROUP BY user_id, CAST(ts AS DATE)""",
    "ec_sessions": f"""
        SELECT session_id, user_id, started_at, ended_at, page_count,
               CASE WHEN page_count > 1 THEN duration_seconds END AS duration_seconds,
               {_by_user(cat.REFERRERS)} AS referrer_source FROM user_days""",
    "web_sessions": f"""
        SELECT session_id, 1 AS project_id, 'v' || user_id AS visitor_id, started_at, day,
               duration_seconds, page_count AS pageview_count,
               CAST(page_count = 1 AS INTEGER) AS is_bounce, '/' || first_type AS entry_page,
               '/' || last_type AS exit_page, {_by_user(cat.REFERRERS)} AS referrer_domain,
               {_by_user(cat.UTM_SOURCES)} AS utm_source, {_by_user(cat.UTM_MEDIUMS)} AS utm_medium,
               {_by_user(cat.UTM_CAMPAIGNS)} AS utm_campaign,
               {_by_user(cat.DEVICES)} AS device_type, {_by_user(cat.BROWSERS)} AS browser,
               {_by_user(cat.USER_COUNTRIES)} AS country_code FROM user_days""",
    "web_pageviews": """
        SELECT ts AS "timestamp", 1 AS project_id, 'v' || user_id AS visitor_id,
               '/' || event_type AS url, CAST(floor(value) + 5 AS INTEGER) AS duration_seconds,
               k AS scroll_depth,
               CASE WHEN event_id % 10 = 9 THEN '' ELSE 'v' || (event_id % 3) END AS ab_variant,
               CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS logged_in
        FROM events_v""",
    "web_conversions": """
        SELECT ts AS "timestamp", 1 AS project_id, 'v' || user_id AS visitor_id,
               user_id || '-' || strftime(CAST(ts AS DATE), '%Y%m%d') AS session_id,
               event_type AS goal_name,
               CAST(CASE WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN value ELSE 0 END
                    AS DECIMAL(10,2)) AS revenue
        FROM events_v WHERE event_type IN ('purchase', 'signup')""",
    "cdc_base": """
        SELECT c_custkey AS key, c_acctbal, CAST(-1 AS BIGINT) AS version
        FROM customer_v WHERE c_mktsegment <> 'FURNITURE'""",
    "changes": """
        SELECT o_custkey AS key, o_totalprice AS c_acctbal, o_orderkey AS version,
               CASE WHEN o_orderstatus = 'P' THEN 'D' ELSE 'U' END AS op FROM orders_v""",
    "orders_copy": "SELECT * FROM orders_v WHERE o_orderdate < DATE '2001-07-25'",
    "lineitem_copy": """
        SELECT * REPLACE (CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice + 0.50
                               ELSE l_extendedprice END AS DECIMAL(12,2)) AS l_extendedprice)
        FROM lineitem_v""",
    "customer_copy": """
        SELECT * REPLACE (CASE WHEN c_nationkey <> 7 THEN c_mktsegment END AS c_mktsegment)
        FROM customer_v""",
    "ledger_v": f"""
        SELECT id, run_id, ts, kind, "table", "rows", seconds, bytes_done, total_bytes,
               CASE WHEN run_id <> 'run-9' THEN strategy
                    WHEN kind = 'table_registered' THEN '{cat.STRATEGIES[1]}' END AS strategy, phase
        FROM (
          SELECT event_id AS id, 'run-' || (user_id % 10) AS run_id, ts,
                 CASE WHEN user_id % 10 = 9 THEN
                        CASE event_type WHEN 'signup' THEN 'phase_started'
                             WHEN 'view' THEN 'bytes_progress' WHEN 'click' THEN 'bytes_progress'
                             WHEN 'purchase' THEN 'bytes_progress' ELSE 'table_registered' END
                      ELSE CASE event_type WHEN 'view' THEN 'batch_done'
                             WHEN 'click' THEN 'bytes_progress' WHEN 'purchase' THEN 'table_done'
                             WHEN 'signup' THEN 'phase_started' ELSE 'log' END END AS kind,
                 't' || (user_id % 3) AS "table", CAST(k * 1000 AS BIGINT) AS "rows",
                 CAST(value / 10 AS DECIMAL(12,3)) AS seconds,
                 event_id * 1000000 AS bytes_done,
                 event_id * 1000000 + 500000000 AS total_bytes,
                 {_pick(cat.STRATEGIES, 'user_id % 3')} AS strategy,
                 {_pick(cat.PHASES, 'k % 4')} AS phase
          FROM events_v)""",
    "bench_v": """
        SELECT 'run-' || (user_id % 10) AS run_id, event_id AS query_n,
               CAST(value * 10 AS DOUBLE) AS source_ms,
               CASE WHEN event_type <> 'error' THEN CAST(k AS DOUBLE) END AS target_ms,
               CAST(value * 10 AS DOUBLE) + k * 3 AS source_wall_ms,
               CASE WHEN event_type <> 'error' THEN CAST(k AS DOUBLE) + 60 END AS target_wall_ms,
               CAST(k * 10 AS BIGINT) AS source_rows,
               CASE WHEN event_type = 'error' THEN NULL
                    WHEN event_type = 'click' THEN CAST(k * 10 + 1 AS BIGINT)
                    ELSE CAST(k * 10 AS BIGINT) END AS target_rows,
               CAST(NULL AS VARCHAR) AS source_error,
               CASE WHEN event_type = 'error' THEN 'timeout' END AS target_error
        FROM events_v""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it names, directly or through other views."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(body)

    visit(sql)
    if not needed:
        return sql.strip()
    prefix = ",\n".join(f"{n} AS ({b.strip()})" for n, b in VIEWS.items() if n in needed)
    body = sql.strip()
    if re.match(r"(?i)with\s", body):
        return f"WITH {prefix},\n{body[4:].strip()}"
    return f"WITH {prefix}\n{body}"
