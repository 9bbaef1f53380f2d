"""Workload preparation on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.catalog import AS_OF_ORDERS, SNAPSHOT_DAYS, WAREHOUSES, Tables, date_lit
from tablehaul.functions.scalars import map_text
from tablehaul.operators.augment import hash_sample, missing_grid, refresh_total
from tablehaul.operators.rollup import rollup_build, rollup_merge
from tablehaul.plans.specs import ORDER_SUMMARY
from tablehaul.registry import query

FIELDS = ["payment_method", "customer_segment", "order_source"]


@query("order_metadata_struct", """
    SELECT o_orderkey, payment_method, customer_segment, order_source, shipping_expedited
    FROM orders_aug""")
def order_metadata_struct(t: Tables) -> DataFrame:
    return t.orders_aug("struct").select("o_orderkey", "order_metadata.*")


@query("order_metadata_map", """
    SELECT o_orderkey, payment_method, customer_segment, order_source,
           CASE WHEN shipping_expedited THEN '1' ELSE '0' END AS shipping_expedited
    FROM orders_aug""")
def order_metadata_map(t: Tables) -> DataFrame:
    return t.orders_aug("map").select(
        "o_orderkey",
        *[map_text("order_metadata", f).alias(f) for f in [*FIELDS, "shipping_expedited"]],
    )


@query("order_metadata_json", """
    SELECT o_orderkey, CAST(json_object('payment_method', payment_method, 'customer_segment',
             customer_segment, 'order_source', order_source, 'shipping_expedited',
             shipping_expedited) AS VARCHAR) AS order_metadata, payment_method AS from_variant
    FROM orders_aug""")
def order_metadata_json(t: Tables) -> DataFrame:
    variant = F.parse_json("order_metadata")
    return t.orders_aug("json").select(
        "o_orderkey", "order_metadata",
        F.variant_get(variant, "$.payment_method", "string").alias("from_variant"),
    )


@query("delivery_at", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, delivery_at FROM lineitem_aug""")
def delivery_at(t: Tables) -> DataFrame:
    return t.lineitem_aug().select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "delivery_at"
    )


@query("contact_addresses", """
    SELECT c_custkey, line, city, country FROM addresses""")
def contact_addresses(t: Tables) -> DataFrame:
    return t.customer_aug().select("c_custkey", F.inline("contact_addresses"))


@query("daily_order_summary", """
    SELECT order_day, o_orderpriority, CAST(order_count AS BIGINT) AS order_count,
           CAST(daily_revenue AS DOUBLE) AS daily_revenue FROM daily_order_summary""")
def daily_order_summary(t: Tables) -> DataFrame:
    orders = t.orders().withColumnRenamed("o_orderdate", "order_day")
    merged = rollup_merge(rollup_build(orders, ORDER_SUMMARY), ORDER_SUMMARY)
    return merged.withColumn("daily_revenue", F.col("daily_revenue").cast("double"))


@query("order_total_refresh", """
    WITH totals AS (
      SELECT order_id, CAST(sum(quantity * unit_price * (1 - discount_pct * CAST(0.01 AS DECIMAL(3,2))))
                            AS DECIMAL(38,2)) AS total FROM ec_order_items GROUP BY order_id)
    SELECT o.order_id, CAST(coalesce(total, total_amount) AS DOUBLE) AS total_amount
    FROM ec_orders o LEFT JOIN totals USING (order_id)""")
def order_total_refresh(t: Tables) -> DataFrame:
    share = F.lit(1) - F.col("discount_pct") * F.lit("0.01").cast("decimal(3,2)")
    totals = t.ec_order_items().groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price") * share)
        .cast("decimal(38,2)").alias("total_amount")
    )
    orders = t.ec_orders().select("order_id", "total_amount")
    refreshed = refresh_total(orders, totals, "order_id", "total_amount")
    return refreshed.withColumn("total_amount", F.col("total_amount").cast("double"))


@query("lifetime_value_refresh", """
    WITH delivered AS (SELECT user_id, sum(total_amount) AS ltv FROM ec_orders
                       WHERE status = 'delivered' GROUP BY user_id)
    SELECT c_custkey AS user_id, CAST(coalesce(ltv, c_acctbal) AS DOUBLE) AS lifetime_value
    FROM customer_v LEFT JOIN delivered ON user_id = c_custkey""")
def lifetime_value_refresh(t: Tables) -> DataFrame:
    """Customers without a delivered order keep the value they had (here their balance)."""
    delivered = t.ec_orders().filter("status = 'delivered'").groupBy("user_id").agg(
        F.sum("total_amount").alias("lifetime_value")
    )
    users = t.customer().select(
        F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("lifetime_value")
    )
    refreshed = refresh_total(users, delivered, "user_id", "lifetime_value")
    return refreshed.withColumn("lifetime_value", F.col("lifetime_value").cast("double"))


@query("inventory_grid", f"""
    WITH grid AS (
      SELECT p_partkey AS product_id, p_size, warehouse_code,
             CAST(DATE '2001-08-02' - CAST(back AS INTEGER) AS DATE) AS snapshot_date
      FROM part, (SELECT unnest({WAREHOUSES}) AS warehouse_code) w,
           (SELECT unnest(range(0, {SNAPSHOT_DAYS})) AS back) d)
    SELECT product_id, warehouse_code, snapshot_date FROM grid
    WHERE NOT (p_size <= 10 AND warehouse_code <> 'WH-CENTRAL'
               AND snapshot_date < DATE '2001-08-01')""")
def inventory_grid(t: Tables) -> DataFrame:
    """Snapshot keys still to be written; small parts were already counted, bar one warehouse."""
    last = AS_OF_ORDERS.date()
    first = last - dt.timedelta(days=SNAPSHOT_DAYS - 1)
    codes = F.array(*[F.lit(w) for w in WAREHOUSES])
    days = F.sequence(date_lit(first), date_lit(last))
    parts = t.part().select(F.col("p_partkey").alias("product_id"), "p_size")
    counted = (
        parts.filter("p_size <= 10")
        .select("product_id", F.explode(codes).alias("warehouse_code"))
        .filter("warehouse_code <> 'WH-CENTRAL'")
        .withColumn("snapshot_date", F.explode(days))
        .filter(F.col("snapshot_date") < date_lit("2001-08-01"))
    )
    return missing_grid(
        parts.select("product_id"), {"warehouse_code": codes, "snapshot_date": days}, counted
    )


SESSION_SAMPLE = 50_000


@query("modulo_join", f"""
    WITH sample AS (SELECT session_id, row_number() OVER (ORDER BY session_id) - 1 AS n
                    FROM (SELECT session_id FROM ec_sessions ORDER BY md5(session_id), session_id
                          LIMIT {SESSION_SAMPLE}))
    SELECT event_id, session_id FROM events JOIN sample
      ON n = event_id % (SELECT count(*) FROM sample)""")
def modulo_join(t: Tables) -> DataFrame:
    """Give every event one of the sampled sessions by its position.

    The sample size is the operator's own bound, so numbering and broadcasting it is safe.
    """
    sample = hash_sample(t.ec_sessions().select("session_id"), "session_id", SESSION_SAMPLE)
    numbered = sample.select(
        "session_id", (F.row_number().over(Window.orderBy("session_id")) - 1).alias("n")
    )
    size = sample.count()
    if not size:
        raise ValueError("no session to sample from")
    events = t.raw("events").select(
        "event_id", F.pmod("event_id", F.lit(size)).cast("int").alias("n")
    )
    return events.join(F.broadcast(numbered), "n").select("event_id", "session_id")
