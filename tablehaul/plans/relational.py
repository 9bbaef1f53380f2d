"""Relational building blocks, one small query each."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablehaul import fixed_values as fv
from tablehaul.catalog import AS_OF_EVENTS, Tables, date_lit, ts_lit
from tablehaul.functions.scalars import trunc_to
from tablehaul.operators.joins import broadcast_checked, left_join_many
from tablehaul.operators.ordered import exact_percentiles, running_total
from tablehaul.operators.series import gap_fill
from tablehaul.registry import query


def rows():
    return F.count(F.lit(1))


# ---- projection and filters ------------------------------------------------


@query("op_project_alias", """
    SELECT o_orderkey AS order_id, o_orderdate AS ordered_on,
           CAST(o_totalprice * 2 AS DOUBLE) AS doubled_price FROM orders_v""")
def op_project_alias(t: Tables) -> DataFrame:
    return t.orders().select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("ordered_on"),
        (F.col("o_totalprice") * 2).cast("double").alias("doubled_price"),
    )


@query("op_filter_in", """
    SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS orders FROM orders_v
    WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus""")
def op_filter_in(t: Tables) -> DataFrame:
    kept = t.orders().filter(F.col("o_orderstatus").isin("F", "O"))
    return kept.groupBy("o_orderstatus").agg(rows().alias("orders"))


@query("op_filter_between", """
    SELECT o_orderkey, o_orderdate FROM orders_v
    WHERE o_orderdate BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'""")
def op_filter_between(t: Tables) -> DataFrame:
    year = F.col("o_orderdate").between(date_lit("1995-01-01"), date_lit("1995-12-31"))
    return t.orders().filter(year).select("o_orderkey", "o_orderdate")


@query("op_filter_neq", """
    SELECT order_id, status FROM ec_orders WHERE status <> 'cancelled'""")
def op_filter_neq(t: Tables) -> DataFrame:
    return t.ec_orders().filter(F.col("status") != "cancelled").select("order_id", "status")


@query("op_filter_notnull", """
    SELECT session_id, CAST(duration_seconds AS BIGINT) AS duration_seconds
    FROM ec_sessions WHERE duration_seconds IS NOT NULL""")
def op_filter_notnull(t: Tables) -> DataFrame:
    kept = t.ec_sessions().filter(F.col("duration_seconds").isNotNull())
    return kept.select("session_id", "duration_seconds")


@query("op_filter_like", """
    SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small_%'""")
def op_filter_like(t: Tables) -> DataFrame:
    return t.part().filter(F.col("p_name").like("small_%")).select("p_partkey", "p_name")


@query("op_filter_time_window", """
    SELECT event_id, ts FROM events_v WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY""")
def op_filter_time_window(t: Tables) -> DataFrame:
    since = AS_OF_EVENTS - dt.timedelta(days=7)
    return t.events().filter(F.col("ts") >= ts_lit(since)).select("event_id", "ts")


@query("op_sargable_range", """
    SELECT o_orderkey, o_orderdate FROM orders_v WHERE strftime(o_orderdate, '%Y%m') = '199606'""")
def op_sargable_range(t: Tables) -> DataFrame:
    """A month as a half-open range on the bare column, which reaches the scan."""
    day = F.col("o_orderdate")
    month = t.orders().filter((day >= date_lit("1996-06-01")) & (day < date_lit("1996-07-01")))
    return month.select("o_orderkey", "o_orderdate")


# ---- joins -----------------------------------------------------------------


@query("op_join_inner", """
    SELECT o_orderkey, c_name FROM orders_v JOIN customer ON o_custkey = c_custkey""")
def op_join_inner(t: Tables) -> DataFrame:
    joined = t.orders().join(t.customer(), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "c_name")


@query("op_join_left", """
    SELECT s.session_id, s.project_id, c.goal_name
    FROM web_sessions s LEFT JOIN web_conversions c
      ON s.session_id = c.session_id AND s.project_id = c.project_id""")
def op_join_left(t: Tables) -> DataFrame:
    goals = t.web_conversions().select("session_id", "project_id", "goal_name")
    sessions = t.web_sessions().select("session_id", "project_id")
    return left_join_many(sessions, goals, ["session_id", "project_id"])


@query("op_join_range", """
    SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS lines_after_order
    FROM lineitem_v JOIN orders_v ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate
    GROUP BY o_orderpriority""")
def op_join_range(t: Tables) -> DataFrame:
    """Lines are counted per order and day before the join: a hot order stays a few rows."""
    lines = t.lineitem().groupBy("l_orderkey", "l_shipdate").agg(rows().alias("lines"))
    joined = lines.join(
        t.orders(),
        (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") >= F.col("o_orderdate")),
    )
    return joined.groupBy("o_orderpriority").agg(F.sum("lines").alias("lines_after_order"))


@query("op_join_cross", f"""
    SELECT c_custkey, order_source FROM customer
    CROSS JOIN (SELECT unnest({fv.ORDER_SOURCES}) AS order_source)""")
def op_join_cross(t: Tables) -> DataFrame:
    """Every customer with every order source; the short literal side is exploded per row."""
    sources = F.array(*[F.lit(s) for s in fv.ORDER_SOURCES])
    return t.customer().select("c_custkey", F.explode(sources).alias("order_source"))


@query("op_join_anti", """
    SELECT c_custkey FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                      AND o_orderdate >= TIMESTAMP '2001-01-01')""")
def op_join_anti(t: Tables) -> DataFrame:
    recent = t.orders().filter(F.col("o_orderdate") >= date_lit("2001-01-01"))
    return t.customer().select("c_custkey").join(
        recent.select("o_custkey").distinct(), F.col("c_custkey") == F.col("o_custkey"),
        "left_anti",
    )


@query("op_join_semi", """
    SELECT c_custkey FROM customer WHERE c_custkey IN
      (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')""")
def op_join_semi(t: Tables) -> DataFrame:
    recent = t.orders().filter(F.col("o_orderdate") >= date_lit("2001-01-01"))
    return t.customer().select("c_custkey").join(
        recent.select("o_custkey").distinct(), F.col("c_custkey") == F.col("o_custkey"),
        "left_semi",
    )


@query("op_join_broadcast", """
    SELECT r_name, CAST(count(*) AS BIGINT) AS customers
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name""")
def op_join_broadcast(t: Tables) -> DataFrame:
    places = t.nation().join(
        broadcast_checked(t.region()), F.col("n_regionkey") == F.col("r_regionkey")
    )
    joined = t.customer().join(
        broadcast_checked(places), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.groupBy("r_name").agg(rows().alias("customers"))


# ---- aggregation -----------------------------------------------------------


@query("op_agg_basic", """
    SELECT l_returnflag, CAST(count(*) AS BIGINT) AS lines,
           CAST(sum(l_extendedprice) AS DOUBLE) AS revenue, avg(l_quantity) AS avg_quantity,
           CAST(min(l_extendedprice) AS DOUBLE) AS lowest,
           CAST(max(l_extendedprice) AS DOUBLE) AS highest
    FROM lineitem_v GROUP BY l_returnflag""")
def op_agg_basic(t: Tables) -> DataFrame:
    return t.lineitem().groupBy("l_returnflag").agg(
        rows().alias("lines"), F.sum("l_extendedprice").cast("double").alias("revenue"),
        F.avg("l_quantity").alias("avg_quantity"),
        F.min("l_extendedprice").cast("double").alias("lowest"),
        F.max("l_extendedprice").cast("double").alias("highest"),
    )


@query("op_agg_conditional", """
    SELECT CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_type = 'view') AS views,
           count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
           CAST(sum(CASE WHEN event_type = 'purchase' THEN value END) AS DOUBLE) AS purchased
    FROM events_v GROUP BY 1""")
def op_agg_conditional(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t.events().groupBy(F.to_date("ts").alias("day")).agg(
        F.count_if(kind == "view").alias("views"),
        F.count_if(kind == "purchase").alias("purchases"),
        F.sum(F.when(kind == "purchase", F.col("value"))).cast("double").alias("purchased"),
    )


@query("op_count_distinct", """
    SELECT event_type, CAST(count(DISTINCT user_id) AS BIGINT) AS users
    FROM events_v GROUP BY event_type""")
def op_count_distinct(t: Tables) -> DataFrame:
    return t.events().groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query("op_uniq_approx")
def op_uniq_approx(t: Tables) -> DataFrame:
    return t.events().groupBy("event_type").agg(
        F.approx_count_distinct("user_id", rsd=0.02).alias("users")
    )


@query("op_percentile_exact", """
    SELECT event_type, CAST(count(*) AS BIGINT) AS n,
           round(quantile_cont(value::DOUBLE, 0.5), 4) AS p50,
           round(quantile_cont(value::DOUBLE, 0.9), 4) AS p90,
           round(quantile_cont(value::DOUBLE, 0.99), 4) AS p99
    FROM events_v GROUP BY event_type""")
def op_percentile_exact(t: Tables) -> DataFrame:
    points = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    found = exact_percentiles(
        t.events().select("event_type", "value"), ["event_type"], "value", points
    )
    return found.select("event_type", "n", *[F.round(p, 4).alias(p) for p in points])


@query("op_percentile_approx")
def op_percentile_approx(t: Tables) -> DataFrame:
    value = F.col("value").cast("double")
    return t.events().groupBy("event_type").agg(*[
        F.percentile_approx(value, p, 10000).alias(n)
        for n, p in {"p50": 0.5, "p90": 0.9, "p99": 0.99}.items()
    ])


@query("op_having", """
    SELECT o_custkey, CAST(count(*) AS BIGINT) AS orders FROM orders
    GROUP BY o_custkey HAVING count(*) >= 10""")
def op_having(t: Tables) -> DataFrame:
    return t.orders().groupBy("o_custkey").agg(rows().alias("orders")).filter("orders >= 10")


GROUPING_SQL = """
    SELECT l_returnflag, l_linestatus, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT)
             AS grouping_level,
           CAST(count(*) AS BIGINT) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
    FROM lineitem_v GROUP BY {kind}(l_returnflag, l_linestatus)"""


def finest_totals(t: Tables) -> DataFrame:
    """Totals of the finest groups; the grouping sets multiply these few rows, not the table."""
    return t.lineitem().groupBy("l_returnflag", "l_linestatus").agg(
        rows().alias("lines"), F.sum("l_quantity").alias("quantity")
    )


def grouped_totals(grouped) -> DataFrame:
    return grouped.agg(
        F.grouping_id().alias("grouping_level"), F.sum("lines").alias("lines"),
        F.sum("quantity").alias("quantity"),
    )


@query("op_rollup", GROUPING_SQL.format(kind="ROLLUP"))
def op_rollup(t: Tables) -> DataFrame:
    return grouped_totals(finest_totals(t).rollup("l_returnflag", "l_linestatus"))


@query("op_cube", GROUPING_SQL.format(kind="CUBE"))
def op_cube(t: Tables) -> DataFrame:
    return grouped_totals(finest_totals(t).cube("l_returnflag", "l_linestatus"))


@query("op_collect", """
    SELECT user_id, CAST(len(kinds) AS BIGINT) AS n_kinds, kinds[1] AS first_kind
    FROM (SELECT user_id, list_sort(list(DISTINCT event_type)) AS kinds
          FROM events_v GROUP BY user_id)""")
def op_collect(t: Tables) -> DataFrame:
    """Distinct event kinds per user; a collected array is bounded by the number of kinds."""
    collected = t.events().groupBy("user_id").agg(
        F.sort_array(F.collect_set("event_type")).alias("kinds")
    )
    return collected.select(
        "user_id", F.size("kinds").cast("long").alias("n_kinds"),
        F.element_at("kinds", 1).alias("first_kind"),
    )


@query("op_string_agg", """
    SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority)
             AS priorities
    FROM orders GROUP BY o_custkey""")
def op_string_agg(t: Tables) -> DataFrame:
    """Distinct priorities per customer; the text is bounded by the number of priorities."""
    return t.orders().groupBy("o_custkey").agg(
        F.array_join(F.sort_array(F.collect_set("o_orderpriority")), ", ").alias("priorities")
    )


# ---- windows ---------------------------------------------------------------


@query("op_window_running", """
    SELECT event_id, user_id,
           CAST(sum(value) OVER (PARTITION BY user_id ORDER BY ts) AS DOUBLE) AS running_value
    FROM events_v""")
def op_window_running(t: Tables) -> DataFrame:
    total = running_total(t.events(), ["user_id"], "ts", "value", "running_value")
    return total.select(
        "event_id", "user_id", F.col("running_value").cast("double").alias("running_value")
    )


@query("op_window_rank", """
    SELECT * FROM (SELECT p_type, p_partkey, p_size,
             CAST(rank() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC) AS INTEGER) AS rk
             FROM part_v) WHERE rk <= 5""")
def op_window_rank(t: Tables) -> DataFrame:
    window = Window.partitionBy("p_type").orderBy(F.desc("p_retailprice"))
    ranked = t.part().withColumn("rk", F.rank().over(window)).filter("rk <= 5")
    return ranked.select("p_type", "p_partkey", "p_size", "rk")


@query("op_window_row_number", """
    SELECT * FROM (SELECT user_id, event_id,
             CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS INTEGER)
               AS rn FROM events_v) WHERE rn <= 3""")
def op_window_row_number(t: Tables) -> DataFrame:
    window = Window.partitionBy("user_id").orderBy(F.desc("ts"), "event_id")
    return (
        t.events().withColumn("rn", F.row_number().over(window)).filter("rn <= 3")
        .select("user_id", "event_id", "rn")
    )


@query("op_window_share", """
    SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS events,
           round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY user_id), 6) AS share
    FROM events_v GROUP BY user_id, event_type""")
def op_window_share(t: Tables) -> DataFrame:
    """The window runs over a handful of aggregated rows per user."""
    counts = t.events().groupBy("user_id", "event_type").agg(rows().alias("events"))
    whole = F.sum("events").over(Window.partitionBy("user_id"))
    return counts.withColumn("share", F.round(F.col("events") / whole, 6))


@query("op_qualify", """
    SELECT o_custkey, o_orderkey, o_orderdate FROM orders_v
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def op_qualify(t: Tables) -> DataFrame:
    window = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey")
    return (
        t.orders().withColumn("rn", F.row_number().over(window)).filter("rn = 1")
        .select("o_custkey", "o_orderkey", "o_orderdate")
    )


# ---- the rest --------------------------------------------------------------


@query("op_topk", """
    SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders_v
    ORDER BY orders_v.o_totalprice DESC, o_orderkey LIMIT 20""")
def op_topk(t: Tables) -> DataFrame:
    top = t.orders().orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
    return top.select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))


@query("op_union_all", """
    SELECT 'order' AS kind, o_orderdate AS day FROM orders_v
    UNION ALL SELECT 'shipment', l_shipdate FROM lineitem_v""")
def op_union_all(t: Tables) -> DataFrame:
    ordered = t.orders().select(F.lit("order").alias("kind"), F.col("o_orderdate").alias("day"))
    shipped = t.lineitem().select(F.lit("shipment").alias("kind"), F.col("l_shipdate").alias("day"))
    return ordered.unionByName(shipped)


@query("op_distinct", """
    SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month FROM orders_v""")
def op_distinct(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders().select((F.year(day) * 100 + F.month(day)).alias("month")).distinct()


@query("op_cte", """
    WITH per_customer AS (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey)
    SELECT CAST(orders AS BIGINT) AS orders, CAST(count(*) AS BIGINT) AS customers
    FROM per_customer GROUP BY orders""")
def op_cte(t: Tables) -> DataFrame:
    per_customer = t.orders().groupBy("o_custkey").agg(rows().alias("orders"))
    return per_customer.groupBy("orders").agg(rows().alias("customers"))


@query("op_gapfill", """
    WITH hours AS (SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31',
                                       INTERVAL 1 HOUR)) AS hour),
    counts AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n, max(value) AS v
               FROM events_v WHERE event_type = 'signup' GROUP BY 1)
    SELECT h.hour, CAST(coalesce(n, 0) AS BIGINT) AS signups,
           CAST(coalesce(v, 0) AS DOUBLE) AS highest
    FROM hours h LEFT JOIN counts c ON h.hour = c.hour""")
def op_gapfill(t: Tables) -> DataFrame:
    counts = t.events().filter("event_type = 'signup'").groupBy(
        trunc_to("hour", "ts").alias("hour")
    ).agg(rows().alias("signups"), F.max("value").cast("double").alias("highest"))
    return gap_fill(
        counts, "hour", dt.datetime(2024, 1, 1), AS_OF_EVENTS, "1 hour",
        {"signups": 0, "highest": 0.0}, inclusive_end=False,
    )


@query("op_unnest", """
    SELECT c_custkey, CAST(addr_offset AS INTEGER) AS position, line, city, country
    FROM addresses""")
def op_unnest(t: Tables) -> DataFrame:
    return t.customer_aug().select(
        "c_custkey", F.posexplode("contact_addresses").alias("position", "address")
    ).select("c_custkey", "position", "address.*")
