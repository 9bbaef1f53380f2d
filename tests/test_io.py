"""Files, layouts, migrations and streams in a temporary folder."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tablehaul import session
from tablehaul.catalog import ts_lit
from tablehaul.operators import progress, validate
from tablehaul.operators.change import cdc_apply
from tablehaul.operators.rollup import Rollup, rollup_build, rollup_merge
from tablehaul.plans.specs import DAILY_STATS
from tablehaul.registry import all_queries
from tablehaul.session import shared_folder
from tablehaul.sources import files, layout, slices
from tablehaul.sources.ledger import Ledger, append_rows, read_ledger
from tablehaul.sources.migrate import Migration, TablePlan, resume_plan
from tablehaul.streaming import jobs
from tests.parity import DATA

SPEC = Rollup(["g"], counts={"n": "1"}, sums={"s": "v"}, distincts={"u": "v"})


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (configured.rstrip("/") if configured else shared_folder(spark))


def test_pipe_delimited_lines_end_with_a_delimiter(spark, folder):
    path = f"{folder}/x.tbl"
    with open(path, "wb") as f:
        f.write("1|café|2.50|\n2||3.00|\n".encode("latin-1"))
    schema = spark.createDataFrame([], "k int, name string, p decimal(6,2)").schema
    got = files.read_pipe_delimited(spark, path, schema)
    assert [(r.k, r.name, str(r.p)) for r in got.orderBy("k").collect()] == [
        (1, "café", "2.50"), (2, None, "3.00")
    ]


def test_stage_export_replaces_an_earlier_try(spark, folder):
    for n in (100, 10):
        stats = files.stage_export(spark.range(n), folder, "run", "t").first()
    assert stats.file_count >= 1 and stats.total_bytes > 0
    assert spark.read.parquet(files.stage_path(folder, "run", "t")).count() == 10


def test_csv_stage(spark, folder):
    assert files.stage_export(spark.range(5), folder, "run", "t", "csv").first().file_count >= 1
    spark.range(2).write.parquet(f"{folder}/target")
    staged = files.stage_path(folder, "run", "t")
    loaded = files.stage_load(spark, staged, f"{folder}/target", "csv").first()
    assert (loaded.rows_before, loaded.rows_done, loaded.rows_after) == (2, 5, 7)


def test_key_slices_cover_the_table(spark):
    df = spark.createDataFrame([(i,) for i in (3, 4, 25, 40, 40)], "k bigint")
    got = [(r["first"], r["last"], r["rows"]) for r in
           slices.slice_rows(df, "k", 10).orderBy("slice").collect()]
    assert got == [(3, 12, 2), (13, 22, 0), (23, 32, 1), (33, 40, 2)]


def test_month_predicates_turn_the_year():
    assert slices.month_predicates([202412], "t") == [
        "t >= DATE '2024-12-01' AND t < DATE '2025-01-01'"
    ]


def test_jdbc_options():
    options = slices.jdbc_range_options("jdbc:x", "t", "k", 1, 10, 1_200_001)
    assert options["numPartitions"] == "3" and options["upperBound"] == "11"


def test_month_layout_prunes_and_spreads_a_hot_key(spark, folder):
    df = spark.range(4000).select(
        F.lit(7).alias("k"), "id",
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 90).cast("int")).alias("d"),
    )
    path = f"{folder}/t"
    # So few rows would be merged into one task again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.write_partition_sorted(df, path, "d", ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = spark.read.parquet(path)
    assert read.count() == 4000
    feb = read.filter(layout.month_filter("d", "2024-02-01", "2024-03-01"))
    assert feb.count() == df.filter("month(d) = 2").count()
    assert "PartitionFilters: [isnotnull(ym" in feb._jdf.queryExecution().executedPlan().toString()
    per_month = files.file_listing(spark, path, "*.parquet").filter("path like '%ym=202402%'")
    assert per_month.count() > 1


def test_swap_rebuild_keeps_the_original_on_a_bad_copy(spark, folder):
    spark.range(10).write.parquet(f"{folder}/a")
    spark.catalog.createTable("swap_me", path=f"{folder}/a", source="parquet")
    with pytest.raises(layout.CopyMismatch):
        layout.swap_rebuild(spark, "swap_me", folder,
                            lambda df, p: df.filter("id > 3").write.parquet(p))
    assert spark.table("swap_me").count() == 10
    layout.swap_rebuild(spark, "swap_me", folder, lambda df, p: df.orderBy("id").write.parquet(p))
    assert spark.table("swap_me").count() == 10
    spark.sql("DROP TABLE swap_me")


def test_versions(spark, folder):
    layout.replace_version(spark.range(3), folder, 1)
    layout.replace_version(spark.range(5), folder, 2)
    layout.replace_version(spark.range(4), folder, 2)
    assert layout.current_version(spark, folder).count() == 4


def test_migration_report_and_rerun(spark, folder):
    def job():
        return (
            Migration(spark, "r", f"{folder}/target", f"{folder}/stage")
            .add_table(TablePlan("facts", spark.range(50), strategy="staged",
                                 transform={"id": F.col("id") * 2}))
            .add_table(TablePlan("dims", spark.range(5), dimension=True))
        )

    for _ in range(2):
        result = job().run()
    assert [(r.table_name, r.strategy, r.matched) for r in result.collect()] == [
        ("dims", "direct", True), ("facts", "staged", True)
    ]
    assert spark.read.parquet(f"{folder}/target/facts").agg(F.max("id")).first()[0] == 98


def test_migration_leaves_a_ledger(spark, folder):
    job = Migration(spark, "r", f"{folder}/target", f"{folder}/stage", f"{folder}/ledger")
    job.add_table(TablePlan("facts", spark.range(50), strategy="staged"))
    job.add_table(TablePlan("dims", spark.range(5), dimension=True))
    result = job.run()
    append_rows(result.select("table_name", "matched"), f"{folder}/ledger", "r", "validation_row")
    events = read_ledger(spark, f"{folder}/ledger")
    assert [r.tag for r in progress.milestones(events).orderBy("id").collect()] == [
        "start", "done", "unload", "staged", "load", "verify", "done", "done"
    ]
    assert progress.phase_durations(events).filter("seconds >= 0").count() == 4
    totals = result.select(F.lit("r").alias("run_id"), F.col("table_name").alias("table"),
                           F.col("source_rows").alias("total_rows"))
    tables = progress.run_tables(events, totals)
    row = progress.kpis(events, tables, progress.run_states(events, ts_lit("2024-01-01"))).first()
    assert (row.pct, row.tables_done, row.tables_total, row.active_tables) == (100.0, 2, 2, 0)
    assert row.inst == 0 and row.eta_sec == 0.0


def test_migration_stops_at_a_failure(spark, folder):
    bad = spark.range(1).select(F.raise_error(F.lit("no")).alias("x"))
    job = Migration(spark, "r", folder, folder)
    job.add_table(TablePlan("a", bad)).add_table(TablePlan("b", spark.range(1)))
    got = {r.table_name: r.status for r in job.run().collect()}
    assert got == {"a": "failed", "b": "pending"}


@pytest.mark.parametrize("name", ["a.b", "a b", '"a"', "", "1a"])
def test_table_names_are_bare(spark, name):
    with pytest.raises(ValueError):
        TablePlan(name, spark.range(1))


def test_resume_plan(spark):
    expected = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5)], "table_name string, rows bigint")
    actual = spark.createDataFrame([("a", 5), ("b", 2)], "table_name string, rows bigint")
    assert {r.table_name: r.action for r in resume_plan(expected, actual).collect()} == {
        "a": "skip", "b": "truncate and reload", "c": "load"
    }


# ---- streams ------------------------------------------------------------------------


@pytest.mark.parametrize("n_files", [1, 3, 8])
def test_stream_rollup_equals_backfill(spark, folder, n_files):
    df = spark.range(500).select(
        F.concat(F.lit("g"), F.col("id") % 3).alias("g"), (F.col("id") % 70).alias("v")
    )
    df.repartition(n_files).write.parquet(f"{folder}/in")
    stream = jobs.read_files(spark, f"{folder}/in", files_per_batch=1)
    jobs.stream_rollup(stream, SPEC, f"{folder}/states", f"{folder}/cp").awaitTermination()
    streamed = jobs.read_rollup(spark, f"{folder}/states", SPEC)
    assert values(streamed) == values(rollup_merge(rollup_build(df, SPEC), SPEC))
    batches = spark.read.parquet(f"{folder}/states/batches")
    assert batches.select("batch_id").distinct().count() == n_files
    jobs.fold_rollup(spark, f"{folder}/states", SPEC)
    folded = jobs.read_batches(spark, f"{folder}/states")
    assert folded.count() == 3
    assert values(jobs.read_rollup(spark, f"{folder}/states", SPEC)) == values(streamed)
    # More files after the fold are read on top of it.
    df.write.mode("append").parquet(f"{folder}/in")
    stream = jobs.read_files(spark, f"{folder}/in", files_per_batch=100)
    jobs.stream_rollup(stream, SPEC, f"{folder}/states", f"{folder}/cp").awaitTermination()
    twice = df.unionByName(df)
    assert values(jobs.read_rollup(spark, f"{folder}/states", SPEC).drop("u")) == values(
        rollup_merge(rollup_build(twice, SPEC), SPEC).drop("u")
    )


def test_stream_replay_changes_nothing(spark, folder):
    spark.range(20).selectExpr("'a' AS g", "id AS v").write.parquet(f"{folder}/in")
    for attempt in (1, 2):  # a new checkpoint repeats every batch number
        stream = jobs.read_files(spark, f"{folder}/in", files_per_batch=100)
        jobs.stream_rollup(
            stream, SPEC, f"{folder}/states", f"{folder}/cp{attempt}"
        ).awaitTermination()
    assert jobs.read_rollup(spark, f"{folder}/states", SPEC).first().n == 20


def test_lagged_refresh_on_a_timer(spark, folder):
    spark.range(20).selectExpr("'a' AS g", "id AS v").repartition(2).write.parquet(f"{folder}/in")
    job = jobs.stream_refresh_lagged(
        jobs.read_files(spark, f"{folder}/in"), SPEC, folder, f"{folder}/cp", lag="1 second"
    )
    job.processAllAvailable()
    job.stop()
    assert jobs.read_refreshed(spark, folder).first().n == 20


def test_stream_cdc_equals_batch(spark, folder):
    base = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, x string, v int")
    changes = spark.createDataFrame(
        [(1, "c", 2, "U"), (2, "", 1, "D"), (1, "d", 1, "U"), (3, "e", 1, "U")],
        "k int, x string, v int, op string",
    )
    changes.repartition(3).write.parquet(f"{folder}/in")
    jobs.stream_cdc(
        jobs.read_files(spark, f"{folder}/in"), ["k"], "v", "op", f"{folder}/log", f"{folder}/cp"
    ).awaitTermination()
    want = values(cdc_apply(base, changes, ["k"], "v", "op"))
    got = jobs.read_cdc(spark, base, f"{folder}/log", ["k"], "v", "op")
    assert values(got) == want
    # Folding keeps delete changes, so an update older than a delete cannot bring a key back.
    jobs.fold_cdc(spark, f"{folder}/log", ["k"], "v", "op")
    late = spark.createDataFrame([(2, "old", 0, "U")], changes.schema)
    late.write.mode("append").parquet(f"{folder}/in")
    jobs.stream_cdc(
        jobs.read_files(spark, f"{folder}/in"), ["k"], "v", "op", f"{folder}/log", f"{folder}/cp"
    ).awaitTermination()
    got = jobs.read_cdc(spark, base, f"{folder}/log", ["k"], "v", "op")
    assert values(got) == want


def test_stream_tail_and_kpis(spark, folder):
    rows = [
        (i, f"r{i % 2}", dt.datetime(2024, 1, 1, 0, 0, i), "batch_done",
         f'{{"table":"t{i % 2}","rows":10,"seconds":2,"strategy":"direct"}}')
        for i in range(1, 21)
    ]
    schema = "id bigint, run_id string, ts timestamp_ntz, kind string, payload_json string"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{folder}/in")
    stream = jobs.read_files(spark, f"{folder}/in")
    jobs.stream_events_tail(stream, 5, f"{folder}/sink", f"{folder}/cp").awaitTermination()
    assert spark.read.parquet(f"{folder}/sink").count() == 15
    totals = spark.createDataFrame(
        [("r0", "t0", 200), ("r1", "t1", 100)], "run_id string, table string, total_rows bigint"
    )
    jobs.stream_progress_kpis(
        jobs.read_files(spark, f"{folder}/in"), totals, f"{folder}/log", f"{folder}/kpis",
        f"{folder}/cp2", ts_lit("2024-01-01 00:01:00"),
    ).awaitTermination()
    got = {r.run_id: (r.pct, r.inst, r.tables_total) for r in
           jobs.read_kpis(spark, f"{folder}/kpis").collect()}
    assert got == {"r0": (50.0, 5, 1), "r1": (100.0, 5, 1)}


# ---- cases found in review -----------------------------------------------------------------


def test_migration_checks_all_plans_before_it_moves_a_row(spark, folder):
    job = Migration(spark, "r", f"{folder}/target", f"{folder}/stage", f"{folder}/ledger")
    job.add_table(TablePlan("good", spark.range(5)))
    job.add_table(TablePlan("bad", spark.range(5), transform={"nope": F.col("missing") + 1}))
    rows = {r.table_name: (r.status, r.error) for r in job.run().collect()}
    assert rows["good"] == ("pending", None) and rows["bad"][0] == "failed" and rows["bad"][1]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/target/good")


def test_a_migrations_own_ledger_feeds_the_progress_figures(spark, folder):
    job = Migration(spark, "r", f"{folder}/target", f"{folder}/stage", f"{folder}/ledger")
    job.add_table(TablePlan("facts", spark.range(50), strategy="staged"))
    job.add_table(TablePlan("dims", spark.range(5), dimension=True))
    job.run()
    events = read_ledger(spark, f"{folder}/ledger")
    tables = progress.run_tables(events, progress.registered_totals(events))
    got = {r.table: (r.total_rows, r.rows_done, r.status, r.strategy) for r in tables.collect()}
    assert got == {"facts": (50, 50, "done", "s3_stage"), "dims": (5, 5, "done", "direct")}
    row = progress.kpis(events, tables, progress.run_states(events, ts_lit("2024-01-01"))).first()
    assert (row.pct, row.tables_done, row.active_tables) == (100.0, 2, 0)
    # As it was in the middle of the staged load: the registration names the strategy.
    loading = events.filter("kind = 'bytes_progress'").orderBy("id").first().id
    part = events.filter(F.col("id") <= loading)
    tables = progress.run_tables(part, progress.registered_totals(part))
    row = progress.kpis(part, tables, progress.run_states(part, ts_lit("2099-01-01"))).first()
    assert (row.active_mode, row.tables_done, row.active_tables) == ("bytes", 1, 1)


def test_running_staged_load_counts_bytes(spark):
    rows = [
        (1, "r", dt.datetime(2024, 1, 1, 0, 0, 0), "table_registered",
         '{"table":"z","strategy":"s3_stage","total_rows":10}'),
        (2, "r", dt.datetime(2024, 1, 1, 0, 0, 1), "bytes_progress",
         '{"table":"z","bytes_done":100,"total_bytes":1000}'),
        (3, "r", dt.datetime(2024, 1, 1, 0, 0, 3), "bytes_progress",
         '{"table":"z","bytes_done":300,"total_bytes":1000}'),
        (4, "r", dt.datetime(2024, 1, 1, 0, 0, 3), "table_registered",
         '{"table":"a","strategy":"direct","total_rows":10}'),
    ]
    events = spark.createDataFrame(
        rows, "id bigint, run_id string, ts timestamp_ntz, kind string, payload_json string"
    )
    tables = progress.run_tables(events, progress.registered_totals(events))
    row = progress.kpis(events, tables, progress.run_states(events, ts_lit("2024-01-01 00:00:10"))).first()
    assert (row.active_mode, row.inst, row.eta_sec) == ("bytes", 100, 7.0)


def test_ledger_ids_are_dense_and_go_on(spark, folder):
    ledger = Ledger(spark, f"{folder}/ledger", "r")
    ledger.add("started")
    ledger.append_rows(spark.range(100).repartition(4), "validation_row")
    ledger.add("done")
    ledger.flush()
    append_rows(spark.range(7).repartition(3), f"{folder}/ledger", "r", "late")
    events = read_ledger(spark, f"{folder}/ledger").orderBy("id").collect()
    assert [e.kind for e in events] == ["started"] + ["validation_row"] * 100 + ["done"] + ["late"] * 7
    ids = [e.id for e in events if e.kind == "validation_row"]
    assert ids == list(range(ids[0], ids[0] + 100)) and len({e.id for e in events}) == 109
    append_rows(spark.range(0), f"{folder}/ledger", "r", "none")
    assert read_ledger(spark, f"{folder}/ledger").count() == 109


def test_versions_without_a_number(spark):
    base = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 5)], "k int, x string, v int")
    changes = spark.createDataFrame([
        (1, "", None, "D"), (2, "", None, "D"), (3, "n", None, "U"), (4, "new", None, "U"),
        (1, "z", None, "U"), (5, "t1", 7, "U"), (5, "t2", 7, "D"), (6, "s1", 3, "U"), (6, "s2", 3, "U"),
    ], "k int, x string, v int, op string")
    got = {(r.k, r.x, r.v) for r in cdc_apply(base, changes, ["k"], "v", "op").collect()}
    six = {r for r in got if r[0] == 6}
    assert got - six == {(1, "a", None), (2, "b", 1), (3, "c", 5), (4, "new", None)}
    assert len(six) == 1
    again = {(r.k, r.x, r.v) for r in cdc_apply(base, changes.repartition(5), ["k"], "v", "op").collect()}
    assert again == got
    newer = spark.createDataFrame([(1, "w", 0, "U"), (1, "v", 9, "D")], changes.schema)
    left = cdc_apply(base, newer, ["k"], "v", "op").filter("k = 1").count()
    assert left == 0


def test_maps_and_variants_are_laid_out_swapped_and_compared(spark, folder):
    df = spark.range(60).select(
        "id", F.expr("date_add(DATE'2024-01-01', CAST(id AS INT))").alias("d"),
        F.create_map(F.lit("a"), F.col("id"), F.lit("b"), F.lit(1)).alias("m"),
        F.parse_json(F.concat(F.lit('{"x":'), F.col("id"), F.lit("}"))).alias("j"),
        F.array(F.struct(F.create_map(F.lit(1), F.lit("x")).alias("n"))).alias("deep"),
    )
    layout.write_partition_sorted(df, f"{folder}/by-month", "d", ["id"])
    assert spark.read.parquet(f"{folder}/by-month").count() == 60
    turned = df.withColumn("m", F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.col("id")))
    assert validate.row_hash_compare(df, turned, ["id"]).count() == 0
    other = df.withColumn("j", F.when(F.col("id") == 5, F.parse_json(F.lit("[1]"))).otherwise(F.col("j")))
    assert [r.id for r in validate.row_hash_compare(df, other, ["id"]).collect()] == [5]
    df.drop("j").write.parquet(f"{folder}/maps")
    spark.catalog.createTable("maps_table", path=f"{folder}/maps", source="parquet")
    swapped = layout.swap_rebuild(
        spark, "maps_table", folder,
        lambda x, p: layout.write_partition_sorted(x, p, "d", ["id"], folders=False),
    )
    assert swapped.columns == ["id", "d", "m", "deep"] and swapped.count() == 60
    with pytest.raises(layout.CopyMismatch, match="columns"):
        layout.swap_rebuild(spark, "maps_table", folder, lambda x, p: x.withColumn("e", F.lit(1)).write.parquet(p))
    with pytest.raises(layout.CopyMismatch, match="rows"):
        layout.swap_rebuild(spark, "maps_table", folder, lambda x, p: x.withColumn("id", F.col("id") + 1).write.parquet(p))
    spark.sql("DROP TABLE maps_table")


def test_a_damaged_file_is_one_error_row(spark, folder):
    good = spark.range(9)
    good.write.parquet(f"{folder}/t")
    part = next(p for p in os.listdir(f"{folder}/t") if p.endswith(".parquet"))
    schema = spark.read.parquet(f"{folder}/t").schema
    with open(f"{folder}/t/{part}", "wb") as f:
        f.write(b"not a table")
    opened = []

    def bad():
        opened.append(1)
        return spark.read.schema(schema).parquet(f"{folder}/t")

    checks = [
        validate.TableCheck("good", lambda: good, lambda: good, required=["id"]),
        validate.TableCheck("bad", lambda: good, bad),
    ]
    rows = {r.table_name: r for r in validate.compare_tables(spark, checks).collect()}
    assert rows["good"].source_rows == rows["good"].target_rows == 9 and rows["good"].target_error is None
    assert rows["bad"].source_rows == 9 and rows["bad"].target_error.startswith("target: ")
    done = spark.createDataFrame([("good",)], "table_name string")
    opened.clear()
    assert validate.compare_tables(spark, checks, done).count() == 1 and not opened


def test_a_stream_reads_only_its_own_files(spark, folder):
    spark.range(5).selectExpr("'a' AS g", "id AS v").coalesce(1).write.parquet(f"{folder}/tmp")
    part = next(p for p in os.listdir(f"{folder}/tmp") if p.endswith(".parquet"))
    shutil.copy(f"{folder}/tmp/{part}", f"{folder}/t.parquet")
    spark.range(7).selectExpr("'a' AS g", "id AS v").write.parquet(f"{folder}/t.parquet_old")
    jobs.stream_rollup(
        jobs.read_files(spark, f"{folder}/t.parquet"), SPEC, f"{folder}/s", f"{folder}/c"
    ).awaitTermination()
    assert jobs.read_rollup(spark, f"{folder}/s", SPEC).first().n == 5


def test_streams_do_not_slow_down_with_age(spark, folder, monkeypatch):
    monkeypatch.setattr(jobs, "FOLD_EVERY", 4)
    monkeypatch.setattr(jobs, "LOG_BUCKETS", 4)
    schema = "id bigint, run_id string, ts timestamp_ntz, kind string, payload_json string"
    n = 50
    rows = [
        (i, f"r{i % 3}", dt.datetime(2024, 1, 1, 0, 0, i), "batch_done",
         f'{{"table":"t{i % 3}","rows":10,"seconds":2,"strategy":"direct"}}') for i in range(n)
    ]
    spark.createDataFrame(rows, schema).repartitionByRange(n, "id").write.parquet(f"{folder}/in")
    totals = spark.createDataFrame(
        [(f"r{i}", f"t{i}", 500) for i in range(3)], "run_id string, table string, total_rows bigint"
    )
    jobs.stream_progress_kpis(
        jobs.read_files(spark, f"{folder}/in", 1), totals, f"{folder}/log", f"{folder}/kpis",
        f"{folder}/cp", ts_lit("2024-01-01 00:01:00"),
    ).awaitTermination()
    got = {r.run_id: r.pct for r in jobs.read_kpis(spark, f"{folder}/kpis").collect()}
    assert got == {f"r{i}": len(range(i, n, 3)) * 10 * 100 / 500 for i in range(3)}
    left = [d for d, _, names in os.walk(f"{folder}/log/batches") if any(f.endswith(".parquet") for f in names)]
    assert len({p.split("batch_id=")[1].split("/")[0] for p in left}) <= 2 * 4
    assert len(os.listdir(f"{folder}/log/folded/versions")) <= 4
    assert sum(f.endswith(".parquet") for _, _, names in os.walk(f"{folder}/kpis") for f in names) <= 12
    spark.range(60).selectExpr("'a' AS g", "id AS v").repartition(12).write.parquet(f"{folder}/in2")
    jobs.stream_refresh_lagged(
        jobs.read_files(spark, f"{folder}/in2", 1), SPEC, f"{folder}/r", f"{folder}/cp2", lag=None
    ).awaitTermination()
    assert jobs.read_refreshed(spark, f"{folder}/r").first().n == 60
    assert len([d for d in os.listdir(f"{folder}/r/states") if d.startswith("data-")]) == 2


def test_a_load_that_is_tried_again_replaces_itself(spark, folder):
    spark.range(4).withColumn("load_id", F.lit("first")).write.partitionBy("load_id").parquet(f"{folder}/t")
    spark.range(10, 16).write.parquet(f"{folder}/staged")
    for _ in range(2):
        row = files.stage_load(spark, f"{folder}/staged", f"{folder}/t", load_id="second").first()
        assert (row.rows_before, row.rows_done, row.rows_after) == (4, 6, 10)


def test_work_tables_go_with_their_job(spark):
    with session.work_tables(spark):
        df = session.saved(spark.range(3), "short-lived")
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        assert df.count() == 3
    assert session.stored_bytes(spark, path) == 0


def test_sketches_and_inventory_are_close_to_exact(spark):
    tables = f"{DATA}/sf0.001"
    q = all_queries()
    key = lambda r: tuple(r[k] for k in DAILY_STATS.keys)
    near = {key(r): r for r in q["daily_stats"](spark, tables).collect()}
    exact = q["daily_stats_exact"](spark, tables).collect()
    assert {key(r) for r in exact} == set(near)
    for r in exact:
        got = near[key(r)]
        for name in ("sessions", "pageviews", "bounces", "total_duration"):
            assert got[name] == r[name], name
        assert got["visitors"] == pytest.approx(r["visitors"], rel=0.05, abs=0.5)
    for r in q["table_inventory"](spark, tables).collect():
        df = spark.read.parquet(f"{tables}/{r.table_name}.parquet")
        assert (r.rows, r.columns) == (df.count(), len(df.columns)) and r.bytes > 0


def test_hot_run_is_written_by_several_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(jobs, "BUCKET_ROWS", 100)
    monkeypatch.setattr(jobs, "FOLD_EVERY", 1)
    merge = "spark.sql.adaptive.coalescePartitions.enabled"  # tasks as small as these are merged
    monkeypatch.setattr(session, "_RUNTIME_SETTINGS", {**session._RUNTIME_SETTINGS, merge: "false"})
    hot = F.col("id") < 1000
    events = spark.range(1200).withColumn("bucket", F.when(hot, 7).otherwise(F.col("id") % 5).cast("int"))
    try:
        session.prepare(spark)
        jobs._write_buckets(events, f"{folder}/batches/{jobs.BATCH}=0")
        jobs._fold_log(spark, folder, 0)
        for path in (f"{folder}/batches/{jobs.BATCH}=0", f"{folder}/folded/data-0"):
            rows = spark.read.parquet(path)
            assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, events.collect()))
            files = rows.select("bucket", F.input_file_name()).distinct().groupBy("bucket").count()
            found = {r["bucket"]: r["count"] for r in files.collect()}
            assert found.pop(7) > 1 and set(found.values()) == {1} and len(found) == 5
    finally:
        monkeypatch.undo()
        session.prepare(spark)
