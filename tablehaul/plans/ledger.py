"""Run ledger and progress queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul import fixed_values as fv
from tablehaul.catalog import AS_OF_EVENTS, Tables, ts_lit
from tablehaul.operators import progress
from tablehaul.operators.validate import union_counts
from tablehaul.registry import query
from tablehaul.sources.migrate import resume_plan as plan_resume

ROWS_PER_BATCH = 100_000


@query("ledger_latest", """
    SELECT run_id, "table", id, kind, "rows" FROM ledger_v
    QUALIFY row_number() OVER (PARTITION BY run_id, "table" ORDER BY id DESC) = 1""")
def ledger_latest(t: Tables) -> DataFrame:
    return progress.ledger_latest(t.ledger_events())


@query("ledger_events_since", f"""
    SELECT id, ts, kind FROM ledger_v WHERE run_id = 'run-3' AND id > 100
    ORDER BY id LIMIT {fv.EVENT_PAGE}""")
def ledger_events_since(t: Tables) -> DataFrame:
    return progress.events_since(t.ledger_events(), "run-3", 100).select("id", "ts", "kind")


ROWS_DONE_SQL = """
    WITH rows_done AS (
      SELECT run_id, "table", max(strategy) AS strategy,
             CASE WHEN max(strategy) = 'direct'
                  THEN coalesce(CAST(sum("rows") FILTER (WHERE kind = 'batch_done') AS BIGINT), 0)
                  ELSE coalesce(max("rows") FILTER (WHERE id = last_done), 0) END AS rows_done
      FROM (SELECT *, max(id) FILTER (WHERE kind = 'table_done')
                        OVER (PARTITION BY run_id, "table") AS last_done FROM ledger_v)
      WHERE kind IN ('batch_done', 'table_done') GROUP BY run_id, "table")"""


@query("ledger_rows_done", ROWS_DONE_SQL + "SELECT * FROM rows_done")
def ledger_rows_done(t: Tables) -> DataFrame:
    return progress.rows_done(t.ledger_events())


RATES_SQL = """
    SELECT run_id, id, CAST(floor(CASE WHEN seconds > 0 THEN "rows" / seconds::DOUBLE ELSE 0 END
                                  + 0.5) AS BIGINT) AS rate
    FROM ledger_v WHERE kind = 'batch_done'"""


@query("prog_batch_rate", RATES_SQL + f"""
    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY id DESC) <= {fv.RATE_SERIES_LENGTH}""")
def prog_batch_rate(t: Tables) -> DataFrame:
    return progress.batch_rate(t.ledger_events())


BYTES_SQL = """
    SELECT run_id, id, "table", CAST(floor(
             CASE WHEN last_kind = 'bytes_progress' AND last_table = "table" AND ms > last_ms
                  THEN greatest(0, (bytes_done - last_bytes) / ((ms - last_ms) / 1000::DOUBLE))
                  ELSE 0 END + 0.5) AS BIGINT) AS rate
    FROM (SELECT *, lag(kind) OVER w AS last_kind, lag("table") OVER w AS last_table,
                 lag(bytes_done) OVER w AS last_bytes, lag(ms) OVER w AS last_ms
          FROM (SELECT *, epoch_us(ts) // 1000 AS ms FROM ledger_v
                WHERE kind IN ('bytes_progress', 'table_done')
                   OR (kind = 'phase_started' AND phase = 'validating'))
          WINDOW w AS (PARTITION BY run_id ORDER BY id))
    WHERE kind = 'bytes_progress'"""


@query("prog_bytes_rate", BYTES_SQL)
def prog_bytes_rate(t: Tables) -> DataFrame:
    return progress.bytes_rate(t.ledger_events())


def run_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events, table states and runs of the ledger fixture; all runs are still going."""
    events = progress.parsed_once(t.ledger_events())
    totals = progress.parsed(events, "table").groupBy("run_id", "table").agg(
        (F.count_if(F.col("kind") == "batch_done") * ROWS_PER_BATCH).alias("total_rows")
    )
    runs = progress.run_states(events, ts_lit(AS_OF_EVENTS))
    return events, progress.run_tables(events, totals), runs


KPIS_SQL = ROWS_DONE_SQL + f""",
    tables AS (
      SELECT a.run_id, a."table", total_rows, coalesce(rows_done, 0) AS rows_done, a.strategy,
             first_id,
             CASE WHEN last_kind = 'table_done' THEN 'done' ELSE 'running' END AS status
      FROM (SELECT run_id, "table", arg_max(kind, id) AS last_kind, min(id) AS first_id,
                   arg_max(strategy, id) FILTER (strategy IS NOT NULL) AS strategy,
                   count(*) FILTER (WHERE kind = 'batch_done') * {ROWS_PER_BATCH} AS total_rows
            FROM ledger_v GROUP BY run_id, "table") a
      LEFT JOIN rows_done r ON a.run_id = r.run_id AND a."table" = r."table"),
    per_run AS (
      SELECT run_id, sum(total_rows) AS total, sum(rows_done) AS done,
             count(*) FILTER (WHERE status = 'done') AS tables_done, count(*) AS tables_total,
             count(*) FILTER (WHERE status = 'running') AS active_tables,
             arg_min(strategy, first_id) FILTER (WHERE status = 'running') AS strategy
      FROM tables GROUP BY run_id),
    row_rates AS ({RATES_SQL}), byte_rates AS ({BYTES_SQL}),
    row_recent AS (SELECT run_id, floor(avg(nullif(rate, 0)) + 0.5) AS rate
                   FROM (SELECT * FROM row_rates QUALIFY row_number() OVER
                         (PARTITION BY run_id ORDER BY id DESC) <= 10) GROUP BY 1),
    byte_recent AS (SELECT run_id, floor(avg(nullif(rate, 0)) + 0.5) AS rate
                    FROM (SELECT * FROM byte_rates QUALIFY row_number() OVER
                          (PARTITION BY run_id ORDER BY id DESC) <= 10) GROUP BY 1),
    last_sample AS (SELECT run_id, kind, bytes_done, total_bytes FROM ledger_v
                    WHERE kind IN ('bytes_progress', 'table_done')
                       OR (kind = 'phase_started' AND phase = 'validating')
                    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY id DESC) = 1),
    started AS (SELECT run_id, min(ts) AS started_at FROM ledger_v GROUP BY run_id),
    mixed AS (
      SELECT p.*, coalesce(strategy <> 'direct', false) AS by_bytes,
             CAST(coalesce(CASE WHEN strategy <> 'direct' THEN b.rate ELSE r.rate END, 0) AS BIGINT)
               AS inst,
             CAST(floor((epoch_us(TIMESTAMP '2024-01-31') // 1000 - epoch_us(started_at) // 1000)
                        / 1000::DOUBLE
                        + 0.5) AS BIGINT) AS elapsed_sec,
             l.kind, l.bytes_done, l.total_bytes
      FROM per_run p JOIN started USING (run_id) LEFT JOIN row_recent r USING (run_id)
           LEFT JOIN byte_recent b USING (run_id) LEFT JOIN last_sample l USING (run_id))
    SELECT run_id, CAST(coalesce(done * 100::DOUBLE / nullif(total, 0), 0) AS DOUBLE) AS pct, inst,
           CAST(coalesce(floor(done / nullif(elapsed_sec, 0)::DOUBLE + 0.5), 0) AS BIGINT) AS cum,
           CAST(CASE WHEN inst = 0 THEN 0
                WHEN by_bytes AND kind = 'bytes_progress'
                THEN greatest(0, total_bytes - bytes_done) / inst::DOUBLE
                ELSE greatest(0, total - done)::DOUBLE / inst END AS DOUBLE) AS eta_sec,
           elapsed_sec, tables_done, tables_total, active_tables,
           CASE WHEN by_bytes THEN 'bytes' ELSE 'rows' END AS active_mode
    FROM mixed"""


@query("prog_kpis", KPIS_SQL)
def prog_kpis(t: Tables) -> DataFrame:
    return progress.kpis(*run_inputs(t))


@query("prog_status", """
    SELECT id, CASE WHEN kind = 'log' THEN 'failed' WHEN kind = 'table_done' THEN 'done'
                    WHEN phase = 'staged' THEN 'paused' ELSE 'running' END AS display_status
    FROM ledger_v""")
def prog_status(t: Tables) -> DataFrame:
    """Every event read as the state of its run: errors cancel, staged phases ask for a pause."""
    p = progress.parsed(t.ledger_events(), "phase")
    status = (
        F.when(F.col("kind") == "log", "cancelled").when(F.col("kind") == "table_done", "done")
        .otherwise("running")
    )
    flag = F.when(F.col("phase") == "staged", "pause").otherwise("run")
    return p.select("id", progress.display_status(status, flag).alias("display_status"))


@query("prog_milestones", f"""
    SELECT run_id, id, strftime(ts, '%H:%M') AS t,
           CASE WHEN kind = 'table_done' THEN 'done' WHEN phase = 'unloading' THEN 'unload'
                WHEN phase = 'staged' THEN 'staged' WHEN phase = 'loading' THEN 'load'
                ELSE 'verify' END AS tag,
           CASE WHEN kind = 'table_done' THEN 'done' WHEN phase IN ('unloading', 'loading')
                THEN 'start' WHEN phase = 'staged' THEN 'done' ELSE 'info' END AS tone,
           CASE WHEN kind = 'table_done'
                THEN "table" || ' complete · ' || format('{{:,}}', "rows") || ' rows'
                WHEN phase = 'unloading' THEN "table" || ' · unloading to S3'
                WHEN phase = 'staged' THEN "table" || ' · staged'
                WHEN phase = 'loading' THEN "table" || ' · loading from S3'
                ELSE "table" || ' · validating row counts' END AS message
    FROM ledger_v WHERE kind IN ('table_done', 'phase_started')
    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY id DESC) <= {fv.MILESTONE_LIMIT}""")
def prog_milestones(t: Tables) -> DataFrame:
    return progress.milestones(t.ledger_events())


@query("prog_phase_durations", """
    SELECT run_id, "table", id, phase, (next_us - us) / 1000000::DOUBLE AS seconds
    FROM (SELECT *, epoch_us(ts) AS us,
                 lead(epoch_us(ts)) OVER (PARTITION BY run_id, "table" ORDER BY id) AS next_us
          FROM ledger_v WHERE kind IN ('phase_started', 'table_done'))
    WHERE kind = 'phase_started'""")
def prog_phase_durations(t: Tables) -> DataFrame:
    return progress.phase_durations(t.ledger_events())


@query("resume_plan", """
    WITH expected AS (SELECT 'orders' AS table_name, count(*) AS n FROM orders
      UNION ALL SELECT 'lineitem', count(*) FROM lineitem
      UNION ALL SELECT 'part', count(*) FROM part
      UNION ALL SELECT 'customer', count(*) FROM customer),
    actual AS (SELECT 'orders' AS table_name, count(*) AS n FROM orders_copy
      UNION ALL SELECT 'lineitem', count(*) FROM lineitem_copy
      UNION ALL SELECT 'customer', count(*) FROM customer_copy)
    SELECT e.table_name, e.n AS expected_rows, a.n AS actual_rows,
           CASE WHEN a.n = e.n THEN 'skip' WHEN coalesce(a.n, 0) = 0 THEN 'load'
                ELSE 'truncate and reload' END AS action
    FROM expected e LEFT JOIN actual a USING (table_name)""")
def resume_plan(t: Tables) -> DataFrame:
    names = ["orders", "lineitem", "customer"]
    expected = union_counts({n: t.raw(n) for n in [*names, "part"]})
    actual = union_counts({n: t.copied(n) for n in names})
    return plan_resume(expected, actual)
