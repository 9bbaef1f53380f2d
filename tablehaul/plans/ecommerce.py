"""E-commerce queries: revenue, funnels, cohorts, top-N, percentiles, ads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.catalog import AS_OF_EVENTS, AS_OF_ORDERS, Tables, date_lit, ts_lit
from tablehaul.functions.scalars import (
    month_boundaries, months_wrapping, ratio_pct, trunc_to,
)
from tablehaul.operators.ordered import exact_percentiles, running_total
from tablehaul.operators.series import gap_fill
from tablehaul.registry import query


def recent_orders(t: Tables, days: int, as_of: dt.datetime = AS_OF_ORDERS) -> DataFrame:
    """Orders of the last ``days``; the day predicate is the one the scan can use."""
    since = as_of - dt.timedelta(days=days)
    return t.ec_orders().filter(
        (F.col("order_day") >= date_lit(since)) & (F.col("created_at") >= ts_lit(since))
    )


@query("ec_daily_revenue", """
    SELECT order_day AS day, country_code AS shipping_country,
           CAST(count(*) AS BIGINT) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS revenue
    FROM ec_orders JOIN ec_users USING (user_id)
    WHERE created_at >= TIMESTAMP '2001-08-02' - INTERVAL 30 DAY
      AND status IN ('delivered', 'shipped')
    GROUP BY order_day, country_code""")
def ec_daily_revenue(t: Tables) -> DataFrame:
    per_user = (
        recent_orders(t, 30).filter(F.col("status").isin("delivered", "shipped"))
        .groupBy("order_day", "user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount"))
    )
    return (
        per_user.join(t.ec_countries(), "user_id")
        .groupBy(F.col("order_day").alias("day"), F.col("country_code").alias("shipping_country"))
        .agg(F.sum("n").alias("order_count"), F.sum("amount").cast("double").alias("revenue"))
    )


@query("ec_running_total", """
    SELECT user_id, order_id, created_at, CAST(total_amount AS DOUBLE) AS total_amount,
           CAST(sum(total_amount) OVER (PARTITION BY user_id ORDER BY created_at) AS DOUBLE)
             AS running_total
    FROM ec_orders WHERE status <> 'cancelled'""")
def ec_running_total(t: Tables) -> DataFrame:
    kept = t.ec_orders().filter("status <> 'cancelled'")
    totals = running_total(kept, ["user_id"], "created_at", "total_amount", "running_total")
    return totals.select(
        "user_id", "order_id", "created_at",
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("running_total").cast("double").alias("running_total"),
    )


@query("ec_funnel", """
    WITH funnel AS (
      SELECT CAST(created_at AS DATE) AS day,
             count(*) FILTER (WHERE event_type = 'page_view') AS views,
             count(*) FILTER (WHERE event_type = 'add_to_cart') AS carts,
             count(*) FILTER (WHERE event_type = 'purchase') AS purchases
      FROM ec_events WHERE created_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY GROUP BY 1)
    SELECT day, views, carts, purchases,
           round(carts * 100.0::DOUBLE / nullif(views, 0), 2) AS view_to_cart_pct,
           round(purchases * 100.0::DOUBLE / nullif(carts, 0), 2) AS cart_to_purchase_pct
    FROM funnel""")
def ec_funnel(t: Tables) -> DataFrame:
    def seen(kind):
        return F.count_if(F.col("event_type") == kind)

    week = t.ec_events().filter(
        F.col("created_at") >= ts_lit(AS_OF_EVENTS - dt.timedelta(days=7))
    )
    steps = week.groupBy(F.to_date("created_at").alias("day")).agg(
        seen("page_view").alias("views"), seen("add_to_cart").alias("carts"),
        seen("purchase").alias("purchases"),
    )
    return steps.withColumns({
        "view_to_cart_pct": ratio_pct(F.col("carts"), F.col("views"), 2),
        "cart_to_purchase_pct": ratio_pct(F.col("purchases"), F.col("carts"), 2),
    })


@query("ec_json_filter", """
    SELECT event_type, CAST(count(*) AS BIGINT) AS cnt FROM ec_events
    WHERE json_extract_string(properties, '$.label') LIKE 'item_%'
      AND CAST(json_extract_string(properties, '$.value') AS DECIMAL(18,4)) > 50
    GROUP BY event_type""")
def ec_json_filter(t: Tables) -> DataFrame:
    label = F.get_json_object("properties", "$.label")
    value = F.get_json_object("properties", "$.value").cast("decimal(18,4)")
    matching = t.ec_events().filter(label.like("item_%") & (value > 50))
    return matching.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


@query("ec_segment_category", """
    SELECT segment, category, CAST(count(DISTINCT order_id) AS BIGINT) AS orders,
           CAST(sum(quantity * unit_price) AS DOUBLE) AS gross_revenue
    FROM ec_orders JOIN ec_users USING (user_id) JOIN ec_order_items USING (order_id)
         JOIN ec_products USING (product_id)
    WHERE status = 'delivered' AND created_at >= TIMESTAMP '2001-08-02' - INTERVAL 90 DAY
    GROUP BY segment, category""")
def ec_segment_category(t: Tables) -> DataFrame:
    orders = recent_orders(t, 90).filter("status = 'delivered'").select("order_id", "user_id")
    segments = orders.join(t.ec_countries(), "user_id").select("order_id", "segment")
    # Repeated lines of one product in one order collapse before they meet the product table.
    lines = t.ec_order_items().join(segments, "order_id").groupBy(
        "order_id", "segment", "product_id"
    ).agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("revenue"))
    named = lines.join(t.ec_products(), "product_id")
    return named.groupBy("segment", "category").agg(
        F.count_distinct("order_id").alias("orders"),
        F.sum("revenue").cast("double").alias("gross_revenue"),
    )


@query("ec_hourly_gapfill", """
    WITH hours AS (
      SELECT unnest(generate_series(TIMESTAMP '2024-01-30 00:00:00',
                                    TIMESTAMP '2024-01-31 00:00:00', INTERVAL 1 HOUR)) AS hour),
    counts AS (
      SELECT date_trunc('hour', created_at) AS hour, count(*) AS cnt FROM ec_events
      WHERE created_at >= TIMESTAMP '2024-01-30' AND event_type = 'signup' GROUP BY 1)
    SELECT h.hour, CAST(coalesce(cnt, 0) AS BIGINT) AS event_count
    FROM hours h LEFT JOIN counts c ON h.hour = c.hour""")
def ec_hourly_gapfill(t: Tables) -> DataFrame:
    since = AS_OF_EVENTS - dt.timedelta(hours=24)
    signups = t.ec_events().filter(
        (F.col("created_at") >= ts_lit(since)) & (F.col("event_type") == "signup")
    )
    counts = signups.groupBy(trunc_to("hour", "created_at").alias("hour")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return gap_fill(counts, "hour", since, AS_OF_EVENTS, "1 hour", {"event_count": 0})


COHORT_SQL = """
    WITH cohorts AS (SELECT user_id, date_trunc('month', registration_date) AS cohort_month
                     FROM ec_users),
    activity AS (SELECT user_id, CAST(date_trunc('month', order_day) AS DATE) AS activity_month
                 FROM ec_orders GROUP BY 1, 2)
    SELECT CAST(cohort_month AS DATE) AS cohort_month,
           CAST({months} AS BIGINT) AS months_since_signup,
           CAST(count(DISTINCT a.user_id) AS BIGINT) AS retained_users
    FROM cohorts c JOIN activity a ON a.user_id = c.user_id AND activity_month >= cohort_month
    GROUP BY 1, 2"""


def cohort_retention(t: Tables, months=month_boundaries) -> DataFrame:
    cohorts = t.ec_users().select(
        "user_id", F.trunc("registration_date", "month").alias("cohort_month")
    )
    activity = t.ec_orders().select(
        F.col("user_id").alias("active_user"),
        F.trunc("order_day", "month").alias("activity_month"),
    ).distinct()
    joined = cohorts.join(
        activity,
        (F.col("user_id") == F.col("active_user"))
        & (F.col("activity_month") >= F.col("cohort_month")),
    )
    since = months(F.col("activity_month"), F.col("cohort_month"))
    return joined.groupBy("cohort_month", since.alias("months_since_signup")).agg(
        F.count_distinct("active_user").alias("retained_users")
    )


@query("ec_cohort_retention",
       COHORT_SQL.format(months="datediff('month', cohort_month, activity_month)"))
def ec_cohort_retention(t: Tables) -> DataFrame:
    return cohort_retention(t)


@query("ec_cohort_retention_wrapping",
       COHORT_SQL.format(months="extract(month FROM age(activity_month, cohort_month))"))
def ec_cohort_retention_wrapping(t: Tables) -> DataFrame:
    return cohort_retention(t, months_wrapping)


def product_revenue(t: Tables) -> DataFrame:
    per_product = t.ec_order_items().groupBy("product_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("revenue")
    )
    return per_product.join(t.ec_products(), "product_id").groupBy("category", "name").agg(
        F.sum("revenue").alias("revenue")
    )


TOPN_SQL = """
    WITH totals AS (SELECT category, name, sum(quantity * unit_price) AS revenue
                    FROM ec_order_items JOIN ec_products USING (product_id)
                    GROUP BY category, name)
    SELECT category, name, CAST(revenue AS DOUBLE) AS revenue, CAST(rk AS INTEGER) AS rk
    FROM (SELECT *, {rank}() OVER (PARTITION BY category ORDER BY {order}) AS rk FROM totals)
    WHERE rk <= 5"""


def topn_category(t: Tables, rank, order: list) -> DataFrame:
    """Best five per category; Spark trims each input partition to five before the shuffle."""
    window = Window.partitionBy("category").orderBy(*order)
    ranked = product_revenue(t).withColumn("rk", rank().over(window)).filter("rk <= 5")
    return ranked.select("category", "name", F.col("revenue").cast("double").alias("revenue"), "rk")


@query("ec_topn_category", TOPN_SQL.format(rank="rank", order="revenue DESC"))
def ec_topn_category(t: Tables) -> DataFrame:
    return topn_category(t, F.rank, [F.desc("revenue")])


@query("ec_topn_category_row_number",
       TOPN_SQL.format(rank="row_number", order="revenue DESC, name"))
def ec_topn_category_row_number(t: Tables) -> DataFrame:
    return topn_category(t, F.row_number, [F.desc("revenue"), "name"])


@query("ec_percentiles", """
    SELECT referrer_source, CAST(count(*) AS BIGINT) AS sessions,
           round(quantile_cont(duration_seconds::DOUBLE, 0.5)) AS p50_sec,
           round(quantile_cont(duration_seconds::DOUBLE, 0.9)) AS p90_sec,
           round(quantile_cont(duration_seconds::DOUBLE, 0.99)) AS p99_sec
    FROM ec_sessions WHERE duration_seconds IS NOT NULL GROUP BY referrer_source""")
def ec_percentiles(t: Tables) -> DataFrame:
    points = {"p50_sec": 0.5, "p90_sec": 0.9, "p99_sec": 0.99}
    found = exact_percentiles(
        t.ec_sessions().select("referrer_source", "duration_seconds"),
        ["referrer_source"], "duration_seconds", points,
    )
    return found.select(
        "referrer_source", F.col("n").alias("sessions"), *[F.round(p, 0).alias(p) for p in points]
    )


@query("ec_ad_ctr", """
    SELECT campaign_id, placement, CAST(count(*) AS BIGINT) AS impressions,
           CAST(sum(clicked::INT) AS BIGINT) AS clicks,
           CAST(sum(converted::INT) AS BIGINT) AS conversions,
           round(sum(clicked::INT) * 100.0::DOUBLE / count(*), 3) AS ctr_pct,
           round(sum(converted::INT) * 100.0::DOUBLE / nullif(sum(clicked::INT), 0), 3) AS cvr_pct,
           round(sum(cost_micros)::DOUBLE / 1e6, 2) AS total_cost_usd
    FROM ec_ad_impressions WHERE impression_at >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY
    GROUP BY campaign_id, placement
    ORDER BY impressions DESC, campaign_id, placement LIMIT 50""")
def ec_ad_ctr(t: Tables) -> DataFrame:
    month = t.ec_ad_impressions().filter(
        F.col("impression_at") >= ts_lit(AS_OF_EVENTS - dt.timedelta(days=30))
    )
    sums = month.groupBy("campaign_id", "placement").agg(
        F.count(F.lit(1)).alias("impressions"),
        F.sum(F.col("clicked").cast("int")).alias("clicks"),
        F.sum(F.col("converted").cast("int")).alias("conversions"),
        F.sum("cost_micros").alias("cost"),
    )
    return (
        sums.orderBy(F.desc("impressions"), "campaign_id", "placement").limit(50)
        .select(
            "campaign_id", "placement", "impressions", "clicks", "conversions",
            ratio_pct(F.col("clicks"), F.col("impressions"), 3).alias("ctr_pct"),
            ratio_pct(F.col("conversions"), F.col("clicks"), 3).alias("cvr_pct"),
            F.round(F.col("cost").cast("double") / 1e6, 2).alias("total_cost_usd"),
        )
    )
