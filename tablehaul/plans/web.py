"""Web-analytics queries over sessions, page views and conversions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.catalog import AS_OF_EVENTS, Tables, date_lit, ts_lit
from tablehaul.functions.scalars import map_text, ratio_pct
from tablehaul.operators.rollup import rollup_build, rollup_merge
from tablehaul.plans.specs import DAILY_STATS
from tablehaul.registry import query

PROJECT = 1
SINCE = dt.datetime(2024, 1, 1)

BOUNCE_SQL = "round(sum(is_bounce) * 100.0::DOUBLE / count(*), 1) AS bounce_rate_pct"


def project_sessions(t: Tables, since: dt.datetime = SINCE) -> DataFrame:
    """Sessions that started since a time. A session is one day of one visitor, so its day
    bounds the events it is made of, and that filter reaches the scan."""
    return t.web_sessions().filter(
        (F.col("project_id") == PROJECT) & (F.col("day") >= date_lit(since))
        & (F.col("started_at") >= ts_lit(since))
    )


def bounce_rate():
    return ratio_pct(F.sum("is_bounce"), F.count(F.lit(1)), 1).alias("bounce_rate_pct")


def average(column: str, digits: int, name: str):
    return F.round(F.avg(column), digits).alias(name)


def labelled(column: str, label: str):
    return F.when(F.col(column) == "", label).otherwise(F.col(column))


def daily_traffic(totals: DataFrame) -> DataFrame:
    return totals.select(
        F.col("day").alias("date"), F.col("visitors").alias("unique_visitors"),
        "sessions", "pageviews",
        ratio_pct(F.col("bounces"), F.col("sessions"), 1).alias("bounce_rate_pct"),
        F.round(F.col("total_duration") / F.col("sessions"), 0).alias("avg_session_duration_sec"),
    )


@query("web_daily_traffic")
def web_daily_traffic(t: Tables) -> DataFrame:
    """Daily traffic from rollup states; distinct visitors are estimated from merged sketches."""
    states = rollup_build(t.web_sessions(), DAILY_STATS).filter(
        (F.col("project_id") == PROJECT)
        & F.col("day").between(date_lit("2024-01-01"), date_lit("2024-12-31"))
    )
    return daily_traffic(rollup_merge(states, DAILY_STATS, by=["day"]))


@query("web_daily_traffic_exact", f"""
    SELECT day AS date, CAST(count(DISTINCT visitor_id) AS BIGINT) AS unique_visitors,
           CAST(count(*) AS BIGINT) AS sessions, CAST(sum(pageview_count) AS BIGINT) AS pageviews,
           {BOUNCE_SQL},
           round(sum(duration_seconds)::DOUBLE / count(*), 0) AS avg_session_duration_sec
    FROM web_sessions WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-12-31' GROUP BY day""")
def web_daily_traffic_exact(t: Tables) -> DataFrame:
    year = t.web_sessions().filter(
        (F.col("project_id") == PROJECT)
        & F.col("day").between(date_lit("2024-01-01"), date_lit("2024-12-31"))
    )
    return daily_traffic(year.groupBy("day").agg(
        F.count_distinct("visitor_id").alias("visitors"),
        F.count(F.lit(1)).alias("sessions"), F.sum("pageview_count").alias("pageviews"),
        F.sum("is_bounce").alias("bounces"), F.sum("duration_seconds").alias("total_duration"),
    ))


@query("web_top_pages", """
    SELECT url, CAST(count(*) AS BIGINT) AS pageviews,
           round(avg(scroll_depth), 1) AS avg_scroll_depth,
           round(avg(duration_seconds), 0) AS avg_time_on_page_sec,
           round(avg(scroll_depth) * avg(duration_seconds) / 100, 1) AS engagement_score
    FROM web_pageviews WHERE "timestamp" >= TIMESTAMP '2024-01-01'
    GROUP BY url HAVING count(*) >= 100
    ORDER BY engagement_score DESC, url LIMIT 20""")
def web_top_pages(t: Tables) -> DataFrame:
    views = t.web_pageviews().filter(
        (F.col("project_id") == PROJECT) & (F.col("timestamp") >= ts_lit(SINCE))
    )
    return (
        views.groupBy("url").agg(
            F.count(F.lit(1)).alias("pageviews"),
            average("scroll_depth", 1, "avg_scroll_depth"),
            average("duration_seconds", 0, "avg_time_on_page_sec"),
            F.round(F.avg("scroll_depth") * F.avg("duration_seconds") / 100, 1)
            .alias("engagement_score"),
        )
        .filter("pageviews >= 100").orderBy(F.desc("engagement_score"), "url").limit(20)
    )


@query("web_attribution", f"""
    SELECT CASE WHEN referrer_domain = '' THEN '(direct)' ELSE referrer_domain END AS source,
           CASE WHEN utm_medium = '' THEN '(none)' ELSE utm_medium END AS medium,
           CAST(count(*) AS BIGINT) AS sessions,
           CAST(count(DISTINCT visitor_id) AS BIGINT) AS unique_visitors, {BOUNCE_SQL},
           round(avg(duration_seconds), 0) AS avg_session_sec,
           round(avg(pageview_count), 1) AS avg_pages_per_session
    FROM web_sessions WHERE started_at >= TIMESTAMP '2024-01-01' GROUP BY 1, 2
    ORDER BY sessions DESC, source, medium LIMIT 25""")
def web_attribution(t: Tables) -> DataFrame:
    return (
        project_sessions(t).groupBy(
            labelled("referrer_domain", "(direct)").alias("source"),
            labelled("utm_medium", "(none)").alias("medium"),
        ).agg(
            F.count(F.lit(1)).alias("sessions"),
            F.count_distinct("visitor_id").alias("unique_visitors"), bounce_rate(),
            average("duration_seconds", 0, "avg_session_sec"),
            average("pageview_count", 1, "avg_pages_per_session"),
        )
        .orderBy(F.desc("sessions"), "source", "medium").limit(25)
    )


@query("web_device_matrix", f"""
    SELECT device_type, browser, CAST(count(*) AS BIGINT) AS sessions, {BOUNCE_SQL},
           round(avg(duration_seconds), 0) AS avg_duration_sec
    FROM web_sessions WHERE started_at >= date_trunc('month', TIMESTAMP '2024-01-31')
    GROUP BY device_type, browser""")
def web_device_matrix(t: Tables) -> DataFrame:
    return project_sessions(t, AS_OF_EVENTS.replace(day=1)).groupBy("device_type", "browser").agg(
        F.count(F.lit(1)).alias("sessions"), bounce_rate(),
        average("duration_seconds", 0, "avg_duration_sec"),
    )


@query("web_conversion_goals", """
    SELECT goal_name, CAST(count(*) AS BIGINT) AS conversions,
           CAST(count(*) FILTER (WHERE revenue > 0) AS BIGINT) AS paid_conversions,
           round(CAST(sum(revenue) AS DOUBLE), 2) AS total_revenue,
           round(CAST(sum(revenue) FILTER (WHERE revenue > 0) AS DOUBLE)
                 / nullif(count(*) FILTER (WHERE revenue > 0), 0), 2) AS avg_order_value,
           CAST(count(DISTINCT visitor_id) AS BIGINT) AS unique_converters
    FROM web_conversions WHERE "timestamp" >= TIMESTAMP '2024-01-01' GROUP BY goal_name""")
def web_conversion_goals(t: Tables) -> DataFrame:
    paid = F.col("revenue") > 0
    goals = t.web_conversions().filter(
        (F.col("project_id") == PROJECT) & (F.col("timestamp") >= ts_lit(SINCE))
    )
    sums = goals.groupBy("goal_name").agg(
        F.count(F.lit(1)).alias("conversions"), F.count_if(paid).alias("paid_conversions"),
        F.sum("revenue").cast("double").alias("all_revenue"),
        F.sum(F.when(paid, F.col("revenue"))).cast("double").alias("paid_revenue"),
        F.count_distinct("visitor_id").alias("unique_converters"),
    )
    return sums.select(
        "goal_name", "conversions", "paid_conversions",
        F.round("all_revenue", 2).alias("total_revenue"),
        F.round(F.try_divide("paid_revenue", "paid_conversions"), 2).alias("avg_order_value"),
        "unique_converters",
    )


def conversions_per_session(t: Tables, since: dt.datetime = SINCE) -> DataFrame:
    """One row per session, so joining it cannot multiply a session with many conversions.

    A session's conversions are of its own day, so those before the first day are not read.
    """
    first = dt.datetime.combine(since.date(), dt.time())
    recent = t.web_conversions().filter(F.col("timestamp") >= ts_lit(first))
    return recent.groupBy("session_id", "project_id").agg(
        F.count(F.lit(1)).alias("conversions"),
        F.count_if(F.col("goal_name") != "").alias("goals"),
        F.sum("revenue").alias("revenue"),
    )


@query("web_geo", """
    SELECT s.country_code, CAST(count(DISTINCT s.visitor_id) AS BIGINT) AS unique_visitors,
           CAST(count(*) AS BIGINT) AS sessions,
           round(sum(is_bounce) * 100.0::DOUBLE / count(*), 1) AS bounce_rate_pct,
           CAST(count(*) FILTER (WHERE c.goal_name <> '') AS BIGINT) AS conversions,
           round(count(*) FILTER (WHERE c.goal_name <> '') * 100.0::DOUBLE / count(*), 2)
             AS conversion_rate_pct
    FROM web_sessions s LEFT JOIN web_conversions c
      ON s.session_id = c.session_id AND s.project_id = c.project_id
    WHERE s.started_at >= TIMESTAMP '2024-01-01' GROUP BY s.country_code
    ORDER BY unique_visitors DESC, country_code LIMIT 30""")
def web_geo(t: Tables) -> DataFrame:
    """Traffic per country; counts have one row per session and conversion, as a join gives."""
    joined = project_sessions(t).join(
        conversions_per_session(t), ["session_id", "project_id"], "left"
    )
    rows = F.greatest(F.coalesce("conversions", F.lit(0)), F.lit(1))
    sums = joined.groupBy("country_code").agg(
        F.count_distinct("visitor_id").alias("unique_visitors"),
        F.sum(rows).cast("long").alias("sessions"),
        F.sum(F.col("is_bounce") * rows).alias("bounces"),
        F.coalesce(F.sum("goals"), F.lit(0)).cast("long").alias("conversions"),
    )
    return (
        sums.select(
            "country_code", "unique_visitors", "sessions",
            ratio_pct(F.col("bounces"), F.col("sessions"), 1).alias("bounce_rate_pct"),
            "conversions",
            ratio_pct(F.col("conversions"), F.col("sessions"), 2).alias("conversion_rate_pct"),
        )
        .orderBy(F.desc("unique_visitors"), "country_code").limit(30)
    )


@query("web_ab_variant", """
    SELECT ab_variant AS variant, CAST(count(*) AS BIGINT) AS pageviews,
           round(avg(scroll_depth), 1) AS avg_scroll_depth,
           round(avg(duration_seconds), 0) AS avg_time_sec,
           round(count(*) FILTER (WHERE scroll_depth >= 75) * 100.0::DOUBLE / count(*), 1)
             AS deep_read_rate_pct,
           round(count(*) FILTER (WHERE logged_in = 'true') * 100.0::DOUBLE / count(*), 1)
             AS logged_in_pct
    FROM web_pageviews WHERE url = '/view' AND "timestamp" >= TIMESTAMP '2024-01-01'
    GROUP BY ab_variant""")
def web_ab_variant(t: Tables) -> DataFrame:
    page = t.web_pageviews().filter(
        (F.col("project_id") == PROJECT) & (F.col("url") == "/view")
        & (F.col("timestamp") >= ts_lit(SINCE))
    )
    rows = F.count(F.lit(1))
    return page.groupBy(map_text("properties", "ab_variant").alias("variant")).agg(
        rows.alias("pageviews"),
        average("scroll_depth", 1, "avg_scroll_depth"),
        average("duration_seconds", 0, "avg_time_sec"),
        ratio_pct(F.count_if(F.col("scroll_depth") >= 75), rows, 1).alias("deep_read_rate_pct"),
        ratio_pct(F.count_if(map_text("properties", "logged_in") == "true"), rows, 1)
        .alias("logged_in_pct"),
    )


@query("web_new_vs_returning", f"""
    WITH firsts AS (SELECT visitor_id, min(started_at) AS first_at FROM web_sessions GROUP BY 1)
    SELECT CASE WHEN started_at = first_at THEN 'new' ELSE 'returning' END AS visitor_type,
           CAST(count(*) AS BIGINT) AS sessions, {BOUNCE_SQL},
           round(avg(duration_seconds), 0) AS avg_duration_sec,
           round(avg(pageview_count), 1) AS avg_pages
    FROM web_sessions JOIN firsts USING (visitor_id)
    WHERE started_at >= TIMESTAMP '2024-01-01' GROUP BY 1""")
def web_new_vs_returning(t: Tables) -> DataFrame:
    """All sessions are summed per visitor; of the first one the sums keep its own values."""
    counted = F.col("started_at") >= ts_lit(SINCE)
    measures = ("is_bounce", "duration_seconds", "pageview_count")
    per_visitor = t.web_sessions().filter(F.col("project_id") == PROJECT).groupBy("visitor_id").agg(
        F.struct(
            F.count_if(counted).alias("sessions"),
            *[F.coalesce(F.sum(F.when(counted, F.col(m))), F.lit(0)).alias(m) for m in measures],
        ).alias("all"),
        F.min_by(F.struct(counted.cast("int").alias("sessions"), *measures), "started_at").alias("first"),
    )
    fields = ("sessions", *measures)
    new = {m: F.col(f"first.{m}") * F.col("first.sessions") for m in fields}
    kinds = F.array(
        F.struct(F.lit("new").alias("visitor_type"), *[new[m].cast("long").alias(m) for m in fields]),
        F.struct(F.lit("returning").alias("visitor_type"), *[
            (F.col(f"all.{m}") - new[m]).cast("long").alias(m) for m in fields
        ]),
    )
    sums = per_visitor.select(F.explode(kinds).alias("k")).select("k.*").groupBy("visitor_type").agg(
        *[F.sum(m).alias(m) for m in fields]
    ).filter("sessions > 0")
    return sums.select(
        "visitor_type", "sessions",
        ratio_pct(F.col("is_bounce"), F.col("sessions"), 1).alias("bounce_rate_pct"),
        F.round(F.col("duration_seconds") / F.col("sessions"), 0).alias("avg_duration_sec"),
        F.round(F.col("pageview_count") / F.col("sessions"), 1).alias("avg_pages"),
    )


@query("web_utm_roi", """
    SELECT CASE WHEN utm_campaign = '' THEN '(no campaign)' ELSE utm_campaign END AS campaign,
           CASE WHEN utm_source = '' THEN '(direct)' ELSE utm_source END AS source,
           CAST(count(DISTINCT s.session_id) AS BIGINT) AS sessions,
           CAST(count(DISTINCT s.visitor_id) AS BIGINT) AS reach,
           CAST(count(c.session_id) AS BIGINT) AS conversions,
           round(count(c.session_id) * 100.0::DOUBLE / count(DISTINCT s.session_id), 2) AS cvr_pct,
           round(CAST(sum(c.revenue) AS DOUBLE), 2) AS total_revenue,
           round(CAST(sum(c.revenue) AS DOUBLE) / nullif(count(DISTINCT s.session_id), 0), 4)
             AS revenue_per_session
    FROM web_sessions s LEFT JOIN web_conversions c
      ON s.session_id = c.session_id AND s.project_id = c.project_id
    WHERE s.started_at >= TIMESTAMP '2024-01-01' AND s.utm_source <> '' GROUP BY 1, 2
    ORDER BY sum(c.revenue) DESC NULLS LAST, campaign, source LIMIT 20""")
def web_utm_roi(t: Tables, fill_unmatched: bool = False) -> DataFrame:
    """Return per campaign.

    With ``fill_unmatched`` a session without a conversion counts as one with no revenue:
    the answer of engines whose outer joins fill in type defaults instead of NULL.
    """
    joined = project_sessions(t).filter("utm_source <> ''").join(
        conversions_per_session(t), ["session_id", "project_id"], "left"
    )
    if fill_unmatched:
        joined = joined.fillna({"conversions": 1}).withColumn(
            "revenue", F.coalesce("revenue", F.lit(0))
        )
    sums = joined.groupBy(
        labelled("utm_campaign", "(no campaign)").alias("campaign"),
        labelled("utm_source", "(direct)").alias("source"),
    ).agg(
        F.count(F.lit(1)).alias("sessions"),  # one row per session
        F.count_distinct("visitor_id").alias("reach"),
        F.coalesce(F.sum("conversions"), F.lit(0)).cast("long").alias("conversions"),
        F.sum("revenue").alias("revenue"),
    )
    revenue = F.col("revenue").cast("double")
    return (
        sums.orderBy(F.desc_nulls_last("revenue"), "campaign", "source").limit(20)
        .select(
            "campaign", "source", "sessions", "reach", "conversions",
            ratio_pct(F.col("conversions"), F.col("sessions"), 2).alias("cvr_pct"),
            F.round(revenue, 2).alias("total_revenue"),
            F.round(revenue / F.col("sessions"), 4).alias("revenue_per_session"),
        )
    )


@query("web_entry_exit", """
    SELECT * FROM (
      SELECT entry_page, exit_page, CAST(count(*) AS BIGINT) AS sessions,
             round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY entry_page), 1)
               AS exit_pct_from_entry,
             round(avg(duration_seconds), 0) AS avg_session_sec,
             round(sum(is_bounce) * 100.0::DOUBLE / count(*), 1) AS bounce_rate_pct
      FROM web_sessions WHERE started_at >= TIMESTAMP '2024-01-01'
      GROUP BY entry_page, exit_page) WHERE sessions >= 50""")
def web_entry_exit(t: Tables) -> DataFrame:
    """Shares are of the whole entry cohort, so the size filter comes after them."""
    pairs = project_sessions(t).groupBy("entry_page", "exit_page").agg(
        F.count(F.lit(1)).alias("sessions"), average("duration_seconds", 0, "avg_session_sec"),
        bounce_rate(),
    )
    # One row per pair of pages enters the window, not one per session.
    cohort = F.sum("sessions").over(Window.partitionBy("entry_page"))
    return pairs.withColumn(
        "exit_pct_from_entry", ratio_pct(F.col("sessions"), cohort, 1)
    ).filter("sessions >= 50")
