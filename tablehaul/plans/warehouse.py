"""Warehouse queries over orders, lines, parts and customers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.catalog import Tables
from tablehaul.functions.scalars import hour_boundaries, hours_exact, hours_whole, map_text
from tablehaul.operators.rollup import rollup_build, rollup_merge
from tablehaul.plans.specs import ORDER_SUMMARY
from tablehaul.registry import query

YEAR_START, YEAR_LAST, YEAR_END = dt.date(1995, 1, 1), dt.date(1995, 12, 31), dt.date(1996, 1, 1)
QUARTER_END = dt.date(1995, 4, 1)


@query("wh_daily_rollup_read", """
    SELECT order_day, o_orderpriority, CAST(order_count AS BIGINT) AS order_count,
           CAST(daily_revenue AS DOUBLE) AS daily_revenue
    FROM daily_order_summary WHERE order_day BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'""")
def wh_daily_rollup_read(t: Tables) -> DataFrame:
    orders = t.orders().withColumnRenamed("o_orderdate", "order_day")
    year = orders.filter(F.col("order_day").between(YEAR_START, YEAR_LAST))
    merged = rollup_merge(rollup_build(year, ORDER_SUMMARY), ORDER_SUMMARY)
    return merged.select(
        "order_day", "o_orderpriority", "order_count",
        F.col("daily_revenue").cast("double").alias("daily_revenue"),
    )


@query("wh_top_customers", """
    SELECT c_custkey, c_name, n_name AS nation, CAST(count(*) AS BIGINT) AS order_count,
           CAST(sum(o_totalprice) AS DOUBLE) AS lifetime_revenue
    FROM orders_v JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderstatus = 'F' GROUP BY c_custkey, c_name, n_name
    ORDER BY sum(o_totalprice) DESC, c_custkey LIMIT 20""")
def wh_top_customers(t: Tables) -> DataFrame:
    # One row per customer before any join, so a customer with many orders costs nothing extra.
    totals = t.orders().filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("order_count"), F.sum("o_totalprice").alias("revenue")
    )
    return (
        totals.join(t.customer(), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation(), F.col("c_nationkey") == F.col("n_nationkey"))
        .orderBy(F.desc("revenue"), "c_custkey").limit(20)
        .select(
            "c_custkey", "c_name", F.col("n_name").alias("nation"), "order_count",
            F.col("revenue").cast("double").alias("lifetime_revenue"),
        )
    )


PAYMENT_SQL = """
    SELECT payment_method, customer_segment, CAST(count(*) AS BIGINT) AS order_count,
           CAST(sum(o_totalprice) AS DOUBLE) AS revenue
    FROM orders_aug WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1996-01-01'
    GROUP BY payment_method, customer_segment"""


def payment_breakdown(t: Tables, form: str, read) -> DataFrame:
    """Orders of one year by two metadata fields; ``read(name)`` extracts a field."""
    year = t.orders_aug(form).filter(
        (F.col("o_orderdate") >= YEAR_START) & (F.col("o_orderdate") < YEAR_END)
    )
    return year.groupBy(
        read("payment_method").alias("payment_method"),
        read("customer_segment").alias("customer_segment"),
    ).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("o_totalprice").cast("double").alias("revenue"),
    )


@query("wh_payment_breakdown_json", PAYMENT_SQL)
def wh_payment_breakdown_json(t: Tables) -> DataFrame:
    return payment_breakdown(t, "json", lambda n: F.get_json_object("order_metadata", f"$.{n}"))


@query("wh_payment_breakdown_map", PAYMENT_SQL)
def wh_payment_breakdown_map(t: Tables) -> DataFrame:
    return payment_breakdown(t, "map", lambda n: map_text("order_metadata", n))


@query("wh_payment_breakdown_struct", PAYMENT_SQL)
def wh_payment_breakdown_struct(t: Tables) -> DataFrame:
    return payment_breakdown(t, "struct", lambda n: F.col("order_metadata").getField(n))


@query("wh_payment_breakdown_variant", PAYMENT_SQL)
def wh_payment_breakdown_variant(t: Tables) -> DataFrame:
    return payment_breakdown(
        t, "variant", lambda n: F.variant_get("order_metadata", f"$.{n}", "string")
    )


def delivery_latency(t: Tables, hours) -> DataFrame:
    """Average hours from the ship date to the delivery instant, per ship mode."""
    quarter = t.lineitem_aug().filter(
        (F.col("l_shipdate") >= YEAR_START) & (F.col("l_shipdate") < QUARTER_END)
    )
    shipped = F.col("l_shipdate").cast("timestamp_ntz")
    return quarter.groupBy("l_shipmode").agg(
        F.count(F.lit(1)).alias("shipment_count"),
        F.round(F.avg(hours(F.col("delivery_at"), shipped)), 6).alias("avg_delivery_hours"),
    )


def latency_sql(hours: str) -> str:
    return f"""
    SELECT l_shipmode, CAST(count(*) AS BIGINT) AS shipment_count,
           round(avg(CAST({hours} AS DOUBLE)), 6) AS avg_delivery_hours
    FROM lineitem_aug
    WHERE l_shipdate >= DATE '1995-01-01' AND l_shipdate < DATE '1995-04-01'
    GROUP BY l_shipmode"""


@query("wh_delivery_latency_exact",
       latency_sql("epoch_us(delivery_at) - epoch_us(CAST(l_shipdate AS TIMESTAMP))")
       .replace("AS DOUBLE))", "AS DOUBLE) / 3.6e9)"))
def wh_delivery_latency_exact(t: Tables) -> DataFrame:
    return delivery_latency(t, hours_exact)


@query("wh_delivery_latency_trunc",
       latency_sql("datesub('hour', CAST(l_shipdate AS TIMESTAMP), delivery_at)"))
def wh_delivery_latency_trunc(t: Tables) -> DataFrame:
    return delivery_latency(t, hours_whole)


@query("wh_delivery_latency_boundary",
       latency_sql("datediff('hour', CAST(l_shipdate AS TIMESTAMP), delivery_at)"))
def wh_delivery_latency_boundary(t: Tables) -> DataFrame:
    return delivery_latency(t, hour_boundaries)


@query("wh_part_revenue", """
    SELECT p_brand, p_type,
           CAST(sum(l_extendedprice * (1 - l_discount)) AS DOUBLE) AS net_revenue,
           CAST(sum(l_quantity) AS BIGINT) AS qty_sold
    FROM lineitem_v JOIN part ON l_partkey = p_partkey
    WHERE l_shipdate BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'
    GROUP BY p_brand, p_type
    ORDER BY sum(l_extendedprice * (1 - l_discount)) DESC, p_brand, p_type LIMIT 50""")
def wh_part_revenue(t: Tables) -> DataFrame:
    year = t.lineitem().filter(F.col("l_shipdate").between(YEAR_START, YEAR_LAST))
    # Sum per part first: the join then sees each part once, however hot it is.
    per_part = year.groupBy("l_partkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        F.sum("l_quantity").alias("qty"),
    )
    return (
        per_part.join(t.part(), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand", "p_type")
        .agg(F.sum("revenue").alias("revenue"), F.sum("qty").alias("qty_sold"))
        .orderBy(F.desc("revenue"), "p_brand", "p_type").limit(50)
        .select("p_brand", "p_type", F.col("revenue").cast("double").alias("net_revenue"),
                "qty_sold")
    )


@query("wh_address_countries", """
    SELECT country, CAST(count(DISTINCT c_custkey) AS BIGINT) AS customers,
           CAST(count(*) AS BIGINT) AS total_addresses
    FROM addresses GROUP BY country""")
def wh_address_countries(t: Tables) -> DataFrame:
    exploded = t.customer_aug().select("c_custkey", F.inline("contact_addresses"))
    return exploded.groupBy("country").agg(
        F.count_distinct("c_custkey").alias("customers"),
        F.count(F.lit(1)).alias("total_addresses"),
    )
