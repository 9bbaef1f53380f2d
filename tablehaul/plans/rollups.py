"""Rollup states, deduplication and change application on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.catalog import Tables
from tablehaul.functions.scalars import yyyymm
from tablehaul.operators.change import cdc_apply as apply_changes
from tablehaul.operators.change import dedup_latest as newest_rows
from tablehaul.operators.rollup import (
    Rollup, rollup_build as build, rollup_merge as merge,
)
from tablehaul.plans.specs import DAILY_STATS, ORDER_SUMMARY
from tablehaul.registry import query
from tablehaul.session import work_path
from tablehaul.sources.buckets import BucketedTable
from tablehaul.sources.layout import current_version, replace_version
from tablehaul.sources.states import compact_folders

SUMMARY_SQL = """
    SELECT order_day, o_orderpriority, CAST(order_count AS BIGINT) AS order_count,
           CAST(daily_revenue AS DOUBLE) AS daily_revenue FROM daily_order_summary"""


def orders_by_day(t: Tables) -> DataFrame:
    return t.orders().withColumnRenamed("o_orderdate", "order_day")


def batches(t: Tables) -> DataFrame:
    """States as three inserts would leave them, one per order status: keys repeat."""
    per_status = Rollup(
        [*ORDER_SUMMARY.keys, "o_orderstatus"], ORDER_SUMMARY.counts, ORDER_SUMMARY.sums
    )
    return build(orders_by_day(t), per_status).drop("o_orderstatus")


def shown(df: DataFrame) -> DataFrame:
    return df.withColumn("daily_revenue", F.col("daily_revenue").cast("double"))


@query("rollup_build", SUMMARY_SQL)
def rollup_build(t: Tables) -> DataFrame:
    return shown(build(orders_by_day(t), ORDER_SUMMARY))


@query("rollup_merge", SUMMARY_SQL)
def rollup_merge(t: Tables) -> DataFrame:
    return shown(merge(batches(t), ORDER_SUMMARY))


@query("rollup_uniq_state")
def rollup_uniq_state(t: Tables) -> DataFrame:
    """Distinct users per event type, merged from one sketch per type and day."""
    spec = Rollup(["day", "event_type"], distincts={"users": "user_id"})
    states = build(t.events().withColumn("day", F.to_date("ts")), spec)
    return merge(states, spec, by=["event_type"])


@query("rollup_avg_state", """
    SELECT event_type, CAST(sum(value) AS DOUBLE) / count(value) AS avg_value
    FROM events_v GROUP BY event_type""")
def rollup_avg_state(t: Tables) -> DataFrame:
    spec = Rollup(["day", "event_type"], averages={"avg_value": "value"})
    states = build(t.events().withColumn("day", F.to_date("ts")), spec)
    return merge(states, spec, by=["event_type"])


@query("rollup_quantile_state")
def rollup_quantile_state(t: Tables) -> DataFrame:
    """Median value per event type, merged from one sketch per type and day."""
    spec = Rollup(["day", "event_type"], quantiles={"median_value": ("value", 0.5)})
    states = build(t.events().withColumn("day", F.to_date("ts")), spec)
    return merge(states, spec, by=["event_type"])


@query("daily_stats")
def daily_stats(t: Tables) -> DataFrame:
    """The web rollup read back at its own keys; visitors are sketch estimates."""
    return merge(build(t.web_sessions(), DAILY_STATS), DAILY_STATS)


@query("daily_stats_exact", """
    SELECT day, project_id, referrer_domain, device_type, country_code,
           CAST(count(*) AS BIGINT) AS sessions, CAST(sum(pageview_count) AS BIGINT) AS pageviews,
           CAST(sum(is_bounce) AS BIGINT) AS bounces,
           CAST(sum(duration_seconds) AS BIGINT) AS total_duration,
           CAST(count(DISTINCT visitor_id) AS BIGINT) AS visitors
    FROM web_sessions GROUP BY ALL""")
def daily_stats_exact(t: Tables) -> DataFrame:
    return t.web_sessions().groupBy(*DAILY_STATS.keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        *[F.sum(e).alias(n) for n, e in DAILY_STATS.sums.items()],
        F.count_distinct("visitor_id").alias("visitors"),
    )


@query("rollup_backfill", SUMMARY_SQL)
def rollup_backfill(t: Tables) -> DataFrame:
    """Fill a state table from the rows that exist, with the definition the stream uses."""
    path = work_path(t.spark, "rollup-backfill")
    build(orders_by_day(t), ORDER_SUMMARY).write.mode("overwrite").parquet(path)
    return shown(merge(t.spark.read.parquet(path), ORDER_SUMMARY))


@query("rollup_compact", SUMMARY_SQL)
def rollup_compact(t: Tables) -> DataFrame:
    """State rows of several inserts in month folders; only months in which keys repeat are
    folded, one row per key, and written again."""
    path = work_path(t.spark, "rollup-compact")
    by_month = batches(t).withColumn("ym", yyyymm("order_day"))
    by_month.repartition("ym").write.partitionBy("ym").parquet(path)
    compact_folders(t.spark, path, ORDER_SUMMARY, "ym")
    folded = t.spark.read.parquet(path)
    # Nothing is merged by the reader any more.
    return shown(folded.drop("ym"))


@query("rollup_refresh_full", SUMMARY_SQL)
def rollup_refresh_full(t: Tables) -> DataFrame:
    """Recompute a stale rollup and put the new version in its place."""
    root = work_path(t.spark, "rollup-refresh")
    stale = t.copied("orders").withColumnRenamed("o_orderdate", "order_day")
    replace_version(build(stale, ORDER_SUMMARY), root, 1)
    replace_version(build(orders_by_day(t), ORDER_SUMMARY), root, 2)
    return shown(current_version(t.spark, root))


@query("dedup_latest", """
    SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice
    FROM orders_v QUALIFY row_number() OVER
      (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def dedup_latest(t: Tables) -> DataFrame:
    newest = newest_rows(t.orders(), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return newest.select(
        "o_custkey", "o_orderkey", "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
    )


CDC_SQL = """
    WITH latest AS (SELECT * FROM changes
                    QUALIFY row_number() OVER (PARTITION BY key ORDER BY version DESC) = 1)
    SELECT coalesce(b.key, l.key) AS key, CAST(coalesce(l.version, b.version) AS BIGINT) AS version,
           CAST(coalesce(l.c_acctbal, b.c_acctbal) AS DOUBLE) AS c_acctbal
    FROM cdc_base b FULL JOIN latest l ON b.key = l.key WHERE coalesce(l.op, 'U') <> 'D'"""


def balance_as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("cdc_apply", CDC_SQL)
def cdc_apply(t: Tables) -> DataFrame:
    return balance_as_double(apply_changes(t.cdc_base(), t.changes(), ["key"], "version", "op"))


@query("cdc_apply_stored", CDC_SQL)
def cdc_apply_stored(t: Tables) -> DataFrame:
    """The same changes applied to a stored table in two batches, the later versions first."""
    root = work_path(t.spark, "cdc-stored")
    table = BucketedTable(t.spark, f"cdc_{uuid.uuid4().hex[:8]}", root, ["key"], "version")
    table.create(t.cdc_base())
    late = F.col("version") % 3 == 0
    for part in (t.changes().filter(late), t.changes().filter(~late)):
        table.apply(part, "op")
    return balance_as_double(table.read())
