"""Benchmark analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul import fixed_values as fv
from tablehaul.catalog import Tables
from tablehaul.operators import compare
from tablehaul.operators.rollup import rollup_build, rollup_merge
from tablehaul.plans.specs import ORDER_SUMMARY
from tablehaul.registry import query
from tablehaul.session import work_path
from tablehaul.sources.layout import month_filter, write_partition_sorted


@query("bench_run")
def bench_run(t: Tables) -> DataFrame:
    """Raw table against rollup, and unsorted table against month folders."""
    orders = t.orders().withColumnRenamed("o_orderdate", "order_day")
    rollup, layout = work_path(t.spark, "bench-rollup"), work_path(t.spark, "bench-layout")
    rollup_build(orders, ORDER_SUMMARY).write.mode("overwrite").parquet(rollup)
    write_partition_sorted(t.lineitem(), layout, "l_shipdate", ["l_orderkey"])

    def from_states():
        return rollup_merge(t.spark.read.parquet(rollup), ORDER_SUMMARY)

    def month(lines: DataFrame):
        return lines.groupBy("l_returnflag").agg(F.sum("l_extendedprice").alias("revenue"))

    june = (F.col("l_shipdate") >= F.lit("1996-06-01").cast("date")) & (
        F.col("l_shipdate") < F.lit("1996-07-01").cast("date")
    )
    rows = compare.bench_run(t.spark, [
        ("daily summary",
         lambda: rollup_merge(rollup_build(orders, ORDER_SUMMARY), ORDER_SUMMARY), from_states),
        ("one month of lines", lambda: month(t.lineitem().filter(june)),
         lambda: month(t.spark.read.parquet(layout).filter(
             month_filter("l_shipdate", "1996-06-01", "1996-07-01")))),
    ])
    return compare.rows_match(compare.with_speedup(rows))


@query("bench_speedup", """
    SELECT run_id, query_n, CASE WHEN target_ms > 0 THEN source_ms / target_ms END AS speedup
    FROM bench_v""")
def bench_speedup(t: Tables) -> DataFrame:
    return compare.with_speedup(t.bench_rows()).select("run_id", "query_n", "speedup")


@query("bench_summary", """
    SELECT run_id, count(*) AS queries,
           count(*) FILTER (WHERE source_error IS NULL AND target_error IS NULL) AS completed,
           round(avg(CASE WHEN target_ms > 0 THEN source_ms / target_ms END), 6) AS avg_speedup
    FROM bench_v GROUP BY run_id""")
def bench_summary(t: Tables) -> DataFrame:
    summary = compare.bench_summary(t.bench_rows(), ["run_id"])
    return summary.withColumn("avg_speedup", F.round("avg_speedup", 6))


@query("bench_wall_overhead", f"""
    SELECT run_id, query_n,
           CASE WHEN source_wall_ms - source_ms >= {fv.WALL_OVERHEAD_LOG_MS}
                THEN source_wall_ms - source_ms END AS source_overhead_ms,
           CASE WHEN target_wall_ms - target_ms >= {fv.WALL_OVERHEAD_VIEW_MS}
                THEN target_wall_ms - target_ms END AS target_overhead_ms
    FROM bench_v""")
def bench_wall_overhead(t: Tables) -> DataFrame:
    logged = compare.wall_overhead(t.bench_rows(), fv.WALL_OVERHEAD_LOG_MS, "source")
    both = compare.wall_overhead(logged, fv.WALL_OVERHEAD_VIEW_MS, "target")
    return both.select("run_id", "query_n", "source_overhead_ms", "target_overhead_ms")


@query("bench_slow_flags", f"""
    SELECT * FROM (
      SELECT run_id, query_n,
             CASE WHEN source_ms / target_ms < 1 THEN 'target slower'
                  WHEN source_ms / target_ms < {fv.WEAK_SPEEDUP} THEN 'weak speedup' END AS flag
      FROM bench_v WHERE target_ms > 0) WHERE flag IS NOT NULL""")
def bench_slow_flags(t: Tables) -> DataFrame:
    return compare.slow_flags(t.bench_rows()).select("run_id", "query_n", "flag")


@query("bench_rows_match", """
    SELECT run_id, query_n, coalesce(source_rows = target_rows, false) AS rows_match FROM bench_v""")
def bench_rows_match(t: Tables) -> DataFrame:
    return compare.rows_match(t.bench_rows()).select("run_id", "query_n", "rows_match")
