"""Streaming jobs run to the end of the given tables, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.catalog import AS_OF_EVENTS, Tables, ts_lit
from tablehaul.functions.scalars import yyyymm
from tablehaul.operators import progress
from tablehaul.plans.ledger import KPIS_SQL, ROWS_PER_BATCH
from tablehaul.plans.rollups import CDC_SQL, SUMMARY_SQL, balance_as_double, shown
from tablehaul.plans.specs import ORDER_SUMMARY
from tablehaul.registry import query
from tablehaul.session import work_path
from tablehaul.sources.buckets import BucketedTable
from tablehaul.streaming import jobs


class Arriving(Tables):
    """The same tables and views, read as streams of files."""

    def raw(self, name: str) -> DataFrame:
        return jobs.read_files(self.spark, self.path(name))


def arriving(t: Tables) -> Arriving:
    return Arriving(t.spark, t.sf_dir)


def arriving_orders(t: Tables) -> DataFrame:
    return arriving(t).orders().withColumnRenamed("o_orderdate", "order_day")


@query("stream_rollup", SUMMARY_SQL)
def stream_rollup(t: Tables) -> DataFrame:
    root = work_path(t.spark, "stream-rollup")
    jobs.stream_rollup(
        arriving_orders(t), ORDER_SUMMARY, f"{root}/states", f"{root}/checkpoint"
    ).awaitTermination()
    return shown(jobs.read_rollup(t.spark, f"{root}/states", ORDER_SUMMARY))


@query("stream_cdc", CDC_SQL)
def stream_cdc(t: Tables) -> DataFrame:
    """Changes applied to a stored table, of which each batch rewrites the buckets it touches."""
    root = work_path(t.spark, "stream-cdc")
    table = BucketedTable(t.spark, f"cdc_{uuid.uuid4().hex[:8]}", f"{root}/table", ["key"], "version")
    table.create(t.cdc_base())
    jobs.stream_cdc_table(arriving(t).changes(), table, "op", f"{root}/checkpoint").awaitTermination()
    return balance_as_double(table.read())


@query("stream_cdc_log", CDC_SQL)
def stream_cdc_log(t: Tables) -> DataFrame:
    """The newest changes kept as a log, which readers merge into the base table."""
    root = work_path(t.spark, "stream-cdc-log")
    jobs.stream_cdc(
        arriving(t).changes(), ["key"], "version", "op", f"{root}/log", f"{root}/checkpoint"
    ).awaitTermination()
    return balance_as_double(
        jobs.read_cdc(t.spark, t.cdc_base(), f"{root}/log", ["key"], "version", "op")
    )


@query("stream_refresh_lagged", SUMMARY_SQL)
def stream_refresh_lagged(t: Tables) -> DataFrame:
    root = work_path(t.spark, "stream-refresh")
    jobs.stream_refresh_lagged(
        arriving_orders(t), ORDER_SUMMARY, root, f"{root}/checkpoint", lag=None,
        folder=yyyymm("order_day"),
    ).awaitTermination()
    return shown(jobs.read_refreshed(t.spark, root))


@query("stream_events_tail", """
    SELECT id, run_id, ts, kind FROM ledger_v""")
def stream_events_tail(t: Tables) -> DataFrame:
    root = work_path(t.spark, "stream-tail")
    jobs.stream_events_tail(
        arriving(t).ledger_events(), -1, f"{root}/sink", f"{root}/checkpoint"
    ).awaitTermination()
    return t.spark.read.parquet(f"{root}/sink").select("id", "run_id", "ts", "kind")


@query("stream_progress_kpis", KPIS_SQL)
def stream_progress_kpis(t: Tables) -> DataFrame:
    root = work_path(t.spark, "stream-kpis")
    totals = progress.parsed(t.ledger_events(), "table").groupBy("run_id", "table").agg(
        (F.count_if(F.col("kind") == "batch_done") * ROWS_PER_BATCH).alias("total_rows")
    )
    jobs.stream_progress_kpis(
        arriving(t).ledger_events(), totals, f"{root}/log", f"{root}/kpis",
        f"{root}/checkpoint", ts_lit(AS_OF_EVENTS),
    ).awaitTermination()
    return jobs.read_kpis(t.spark, f"{root}/kpis")
