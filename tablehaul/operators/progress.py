"""Run ledger and progress analytics over an append-only event log.

Events have ``id`` (unique, growing), ``run_id``, ``ts``, ``kind`` and ``payload_json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul import fixed_values as fv
from tablehaul.operators.ordered import neighbour
from tablehaul.session import saved

PAYLOAD = {
    "table": "string", "rows": "bigint", "seconds": "double", "bytes_done": "bigint",
    "total_bytes": "bigint", "strategy": "string", "phase": "string", "total_rows": "bigint",
    "error": "string", "source_type": "string", "target_database": "string",
}
STAGED = ["s3_stage", "gcs_stage"]
TERMINAL = ["done", "failed", "cancelled"]


def parsed(events: DataFrame, *fields: str) -> DataFrame:
    """Events with the named payload fields as columns; the parser skips the others.

    Events that are parsed already only lose the columns not asked for.
    """
    if "payload_json" not in events.columns:
        return events.select("id", "run_id", "ts", "kind", *fields)
    schema = ", ".join(f"`{f}` {PAYLOAD[f]}" for f in fields)
    return events.withColumn("_p", F.from_json("payload_json", schema)).select(
        "id", "run_id", "ts", "kind", "_p.*"
    )


def parsed_once(events: DataFrame) -> DataFrame:
    """Fully parsed events in a table of their own, for analyses that read them many times."""
    return saved(parsed(events, *PAYLOAD), "events")


def half_up(c: Column) -> Column:
    """Nearest whole number, halves upward."""
    return F.floor(c + 0.5).cast("long")


def newest(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest events of every run."""
    window = Window.partitionBy("run_id").orderBy(F.desc("id"))
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")


def ledger_latest(events: DataFrame) -> DataFrame:
    """Last event of every run and table."""
    newest_event = F.max_by(F.struct("id", "kind", "rows"), "id").alias("_e")
    latest = parsed(events, "table", "rows").groupBy("run_id", "table").agg(
        newest_event, F.count("table").alias("_named")
    )
    # Asking the count keeps the check out of the scan, where it would parse every row twice.
    return latest.filter("_named > 0").select("run_id", "table", "_e.*")


def events_since(events: DataFrame, run_id: str, since: int, page: int = fv.EVENT_PAGE) -> DataFrame:
    """The next page of a run's events after an id."""
    later = events.filter((F.col("run_id") == run_id) & (F.col("id") > since))
    return later.orderBy("id").limit(page)


def _loads() -> list[Column]:
    """Per run and table: the strategy, the rows of all batches, and the last staged total.

    Any event may name the strategy, the registration first of all: a staged load has no batch
    before it ends.
    """
    named = F.when(F.col("strategy").isNotNull(), F.col("id"))
    return [
        F.max_by("strategy", named).alias("strategy"),
        F.sum(F.when(F.col("kind") == "batch_done", F.col("rows"))).alias("_batches"),
        F.max_by(
            F.coalesce("total_rows", "rows"), F.when(F.col("kind") == "table_done", F.col("id"))
        ).alias("_staged"),
    ]


def _done() -> Column:
    done = F.when(F.col("strategy").isin(STAGED), F.col("_staged")).otherwise(F.col("_batches"))
    return F.coalesce(done, F.lit(0)).alias("rows_done")


def rows_done(events: DataFrame) -> DataFrame:
    """Rows loaded per run and table: batches add up, a staged load reports one total."""
    loads = events.filter(F.col("kind").isin("batch_done", "table_done"))
    loads = parsed(loads, "table", "rows", "total_rows", "strategy")
    return loads.groupBy("run_id", "table").agg(*_loads()).select(
        "run_id", "table", "strategy", _done()
    )


def _row_rates(events: DataFrame) -> DataFrame:
    batches = parsed(events.filter("kind = 'batch_done'"), "rows", "seconds")
    rate = F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds")).otherwise(0.0)
    return batches.select("run_id", "id", half_up(rate).alias("rate"))


def batch_rate(events: DataFrame) -> DataFrame:
    """Rows per second of the latest batches of every run."""
    return newest(_row_rates(events), fv.RATE_SERIES_LENGTH)


def bytes_rate(events: DataFrame) -> DataFrame:
    """Bytes per second between consecutive samples of one table.

    A finished table or a started validation forgets the previous sample, and so does a
    sample of another table; a falling byte count reads as zero.
    """
    p = parsed(events, "table", "phase", "bytes_done")
    clears = (F.col("kind") == "table_done") | (
        (F.col("kind") == "phase_started") & (F.col("phase") == "validating")
    )
    steps = p.filter((F.col("kind") == "bytes_progress") | clears).select(
        "run_id", "id", "kind", "table", "bytes_done",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
    )
    with_last = neighbour(
        steps, ["run_id"], "id", ["kind", "table", "bytes_done", "ms"]
    )
    seconds = (F.col("ms") - F.col("previous_ms")) / 1000
    follows = (
        (F.col("previous_kind") == "bytes_progress")
        & (F.col("previous_table") == F.col("table")) & (seconds > 0)
    )
    rate = F.when(
        follows, F.greatest(F.lit(0.0), (F.col("bytes_done") - F.col("previous_bytes_done")) / seconds)
    ).otherwise(0.0)
    return with_last.filter("kind = 'bytes_progress'").select(
        "run_id", "id", "table", half_up(rate).alias("rate")
    )


#: Events that may say how many rows a table has.
TELL_TOTALS = ("table_registered", "phase_started", "bytes_progress", "table_done")


def registered_totals(events: DataFrame) -> DataFrame:
    """``run_id, table, total_rows`` of every registered table.

    A registration need not know the rows; the last event of the table that does decides.
    """
    known = parsed(events.filter(F.col("kind").isin(*TELL_TOTALS)), "table", "total_rows")
    told = F.when(F.col("total_rows").isNotNull(), F.col("id"))
    return known.groupBy("run_id", "table").agg(
        F.max_by("total_rows", told).alias("total_rows"),
        F.count_if(F.col("kind") == "table_registered").alias("_registered"),
    ).filter("_registered > 0").drop("_registered")


def run_tables(events: DataFrame, totals: DataFrame) -> DataFrame:
    """State of every table of a run; ``totals`` holds ``run_id, table, total_rows``."""
    states = parsed(events, "table", "rows", "total_rows", "strategy").groupBy("run_id", "table").agg(
        F.max_by("kind", "id").alias("_last"), F.min("id").alias("first_id"), *_loads()
    )
    status = F.when(F.col("_last") == "table_done", "done").otherwise("running")
    known = states.select("run_id", "table", status.alias("status"), "strategy", "first_id", _done())
    return totals.join(known, ["run_id", "table"], "left").fillna(
        {"rows_done": 0, "status": "pending", "total_rows": 0}
    )


def run_states(events: DataFrame, as_of: Column) -> DataFrame:
    """Status, start and end of every run; a run still going ends at ``as_of``."""
    decisive = F.col("kind").isin("started", "resumed", "paused", "done", "failed", "cancelled")
    states = events.groupBy("run_id").agg(
        F.min("ts").alias("started_at"),
        F.max_by("kind", F.when(decisive, F.col("id"))).alias("_kind"),
        F.max(F.when(F.col("kind").isin(TERMINAL), F.col("ts"))).alias("_ended"),
    )
    over = F.col("_kind").isin(TERMINAL)
    status = F.when(over | (F.col("_kind") == "paused"), F.col("_kind")).otherwise("running")
    return states.select(
        "run_id", status.alias("status"), "started_at",
        F.when(over, F.col("_ended")).otherwise(as_of).alias("ended_at"),
    )


def kpis(events: DataFrame, tables: DataFrame, runs: DataFrame) -> DataFrame:
    """Progress of every run.

    ``tables`` is the result of ``run_tables`` and ``runs`` that of ``run_states``. The active
    table of a run is the running one that appeared first.
    """
    running = F.col("status") == "running"
    per_run = tables.groupBy("run_id").agg(
        F.sum("total_rows").alias("total"), F.sum("rows_done").alias("done"),
        F.count_if(F.col("status") == "done").alias("tables_done"),
        F.count(F.lit(1)).alias("tables_total"), F.count_if(running).alias("active_tables"),
        F.min_by("strategy", F.when(running, F.col("first_id"))).alias("active_strategy"),
    )
    mean_rate = half_up(F.avg(F.when(F.col("rate") > 0, F.col("rate"))))

    def recent(rates: DataFrame, name: str) -> DataFrame:
        return newest(rates, fv.RECENT_RATES).groupBy("run_id").agg(mean_rate.alias(name))

    samples = parsed(events, "phase", "bytes_done", "total_bytes").filter(
        F.col("kind").isin("bytes_progress", "table_done")
        | ((F.col("kind") == "phase_started") & (F.col("phase") == "validating"))
    ).groupBy("run_id").agg(
        F.max_by(F.struct("kind", "bytes_done", "total_bytes"), "id").alias("_last")
    )
    joined = (
        runs.withColumnRenamed("status", "run_status").join(per_run, "run_id")
        .join(recent(_row_rates(events), "_row_rate"), "run_id", "left")
        .join(recent(bytes_rate(events).select("run_id", "id", "rate"), "_byte_rate"), "run_id", "left")
        .join(samples, "run_id", "left")
    )
    by_bytes = F.coalesce(F.col("active_strategy").isin(STAGED), F.lit(False))
    live = F.col("run_status").isin("running", "paused")
    inst = F.when(
        live, F.coalesce(F.when(by_bytes, F.col("_byte_rate")).otherwise(F.col("_row_rate")), F.lit(0))
    ).otherwise(0)
    elapsed = F.greatest(F.lit(0), half_up(
        (F.unix_millis(F.col("ended_at").cast("timestamp"))
         - F.unix_millis(F.col("started_at").cast("timestamp"))) / 1000
    ))
    loading = F.coalesce(F.col("_last.kind") == "bytes_progress", F.lit(False))
    rest = F.when(
        by_bytes & loading, F.col("_last.total_bytes") - F.col("_last.bytes_done")
    ).otherwise(F.col("total") - F.col("done"))
    eta = F.when(
        (F.col("run_status") == "running") & (F.col("inst") > 0),
        F.greatest(F.lit(0), rest) / F.col("inst"),
    ).otherwise(0.0)
    return joined.withColumns({"inst": inst.cast("long"), "elapsed_sec": elapsed}).select(
        "run_id",
        F.coalesce(F.col("done") * 100 / F.nullif("total", F.lit(0)), F.lit(0.0)).alias("pct"),
        "inst",
        F.coalesce(half_up(F.col("done") / F.nullif("elapsed_sec", F.lit(0))), F.lit(0)).alias("cum"),
        eta.alias("eta_sec"), "elapsed_sec", "tables_done", "tables_total", "active_tables",
        F.when(by_bytes, "bytes").otherwise("rows").alias("active_mode"),
    )


def display_status(status: Column, flag: Column) -> Column:
    """A pause request shows before the run stops; cancelled runs show as failed."""
    return (
        F.when((flag == "pause") & (status == "running"), "paused")
        .when(status == "cancelled", "failed").otherwise(status)
    )


def _ladder(source: Column, pairs: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for value, result in pairs.items():
        out = F.when(source == value, result).otherwise(out)
    return out


def milestones(events: DataFrame, limit: int = fv.MILESTONE_LIMIT) -> DataFrame:
    """Events worth showing, with a tag, a tone and a message; the newest of every run."""
    p = parsed(
        events, "table", "phase", "rows", "total_rows", "error", "source_type", "target_database"
    )
    shown = p.filter(
        F.col("kind").isin(list(fv.MILESTONES))
        | ((F.col("kind") == "phase_started") & F.col("phase").isin(list(fv.PHASE_MILESTONES)))
    )
    is_phase = F.col("kind") == "phase_started"

    def look(position: int) -> Column:
        return F.when(
            is_phase, _ladder(F.col("phase"), {k: v[position] for k, v in fv.PHASE_MILESTONES.items()})
        ).otherwise(_ladder(F.col("kind"), {k: v[position] for k, v in fv.MILESTONES.items()}))

    table = F.coalesce("table", F.lit(""))
    rows = F.format_number(F.coalesce("total_rows", "rows", F.lit(0)), 0)
    text = (
        F.when(is_phase, F.concat(table, F.lit(" · "), _ladder(F.col("phase"), fv.PHASE_TEXTS)))
        .when(F.col("kind") == "table_done", F.concat(table, F.lit(" complete · "), rows, F.lit(" rows")))
        .when(F.col("kind") == "started", F.concat(
            F.lit("Run started · "), F.coalesce("source_type", F.lit("")), F.lit(" → "),
            F.coalesce("target_database", F.lit("")),
        ))
        .when((F.col("kind") == "failed") & F.col("error").isNotNull(),
              F.concat(F.lit("Failed · "), F.col("error")))
        .otherwise(_ladder(F.col("kind"), fv.MILESTONE_TEXTS))
    )
    return newest(shown, limit).select(
        "run_id", "id", F.date_format("ts", "HH:mm").alias("t"), look(0).alias("tag"),
        look(1).alias("tone"), text.alias("message"),
    )


def phase_durations(events: DataFrame) -> DataFrame:
    """Seconds from each phase of a table to its next phase or its end."""
    steps = events.filter(F.col("kind").isin("phase_started", "table_done"))
    steps = parsed(steps, "table", "phase").select(
        "run_id", "table", "id", "kind", "phase",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
    )
    following = neighbour(steps, ["run_id", "table"], "id", ["us"], step="next")
    return following.filter("kind = 'phase_started'").select(
        "run_id", "table", "id", "phase",
        ((F.col("next_us") - F.col("us")) / 1_000_000).alias("seconds"),
    )
