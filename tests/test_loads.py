"""Loads that tell how far they are, delimited files with bad lines, and timed queries."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, StringType, StructField, StructType

from tablehaul.catalog import Tables
from tablehaul.operators import compare, progress
from tablehaul.sources import files, load
from tablehaul.sources.ledger import read_ledger
from tablehaul.sources.migrate import Migration, TablePlan
from tests.parity import DATA

LINES = """1|good|1.50|2024-01-01|
2|no end|2.5|2024-01-02
3|short|
4|x|notnum|2024-13-01|
5|x|1|2024-01-01|more|
6|x|1|2024-01-01|more
7|"quoted | pipe"|1|2024-01-01|
8|"open|1|2024-01-01|
9|x|1|2024-01-01|a|b|c|
||||

10|é|99999999999.5||
"""
SCHEMA = StructType([
    StructField("id", IntegerType()), StructField("_line", StringType()),
    StructField("p", DecimalType(10, 2)), StructField("d", DateType()),
])
WORD = "p: 'notnum' is no decimal(10,2); d: '2024-13-01' is no date"
LARGE = "p: '99999999999.5' is no decimal(10,2)"


@pytest.fixture
def lines(folder):
    path = f"{folder}/lines.tbl"
    with open(path, "w", encoding="latin-1") as out:
        out.write(LINES)
    return path


@pytest.mark.parametrize("quote,kept,reasons", [
    ('"', [None, 1, 2, 7], {
        3: "2 fields instead of 4", 4: WORD, 5: "5 fields instead of 4", 6: "5 fields instead of 4",
        8: "a quote is not closed", 9: "7 fields instead of 4", 10: LARGE,
    }),
    ("", [None, 1, 2, 8], {
        3: "2 fields instead of 4", 4: WORD, 5: "5 fields instead of 4", 6: "5 fields instead of 4",
        7: "5 fields instead of 4", 9: "7 fields instead of 4", 10: LARGE,
    }),
])
def test_bad_lines_are_told_apart(spark, lines, quote, kept, reasons):
    rows, rejects = files.scan_delimited(spark, lines, SCHEMA, quote)
    assert rows.columns == SCHEMA.names
    assert sorted((r["id"] for r in rows.collect()), key=lambda i: i or 0) == kept
    found = {int(r["line"].split("|")[0]): r for r in rejects.collect()}
    assert {k: r["reason"] for k, r in found.items()} == reasons
    written = {line.split("|")[0]: line for line in LINES.splitlines()}
    assert all(r["line"] == written[str(k)] and r["file"].endswith("lines.tbl") for k, r in found.items())
    # Counts add up, whatever columns a query takes.
    total = sum(bool(line) for line in LINES.splitlines())
    assert rows.count() + rejects.count() == rows.select("_line").count() + len(reasons) == total


def test_a_bad_line_fails_a_read_without_rejects(spark, lines, folder):
    read = files.read_pipe_delimited(spark, lines, SCHEMA)
    for part in (read, read.select("id"), read.agg(F.count(F.lit(1)))):
        with pytest.raises(Exception, match="bad line"):
            part.collect()
    rows = files.read_pipe_delimited(spark, lines, SCHEMA, rejects=f"{folder}/rejects")
    assert rows.count() == 4 and spark.read.parquet(f"{folder}/rejects").count() == 7


def test_quoted_values_survive_a_round_trip(spark, folder):
    schema = StructType([StructField("a", StringType()), StructField("b", IntegerType())])
    rows = [("x|y", 1), ('say "hi"', 2), (None, 3), ("z", None)]
    files.write_pipe_delimited(spark.createDataFrame(rows, schema), f"{folder}/out")
    back = files.read_pipe_delimited(spark, f"{folder}/out", schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_a_load_reports_every_batch(spark, folder):
    spark.range(1000).repartition(8).write.parquet(f"{folder}/staged")
    staged = files.file_listing(spark, f"{folder}/staged", "*.parquet")
    n, size = staged.agg(F.count("path"), F.sum("bytes")).first()
    seen = []
    os.makedirs(f"{folder}/target")
    with open(f"{folder}/target/part-old.parquet", "w") as out:
        out.write("left by an earlier try")
    done = load.stream_load(
        spark, f"{folder}/staged", f"{folder}/target", lambda df: df.withColumn("twice", F.col("id") * 2),
        n, size, lambda rows, done: seen.append((rows, done)),
    )
    assert done == 1000 and seen[-1] == (1000, size) and len(seen) == load.LEAST_STEPS
    assert all(a < b for a, b in zip([(0, 0), *seen], seen))
    table = spark.read.parquet(f"{folder}/target")
    assert table.columns == ["id", "twice"] and table.agg(F.sum("twice")).first()[0] == 999_000
    # An ordinary folder: rows that are appended by a batch job count too.
    table.limit(0).unionByName(spark.range(3).select("id", F.lit(0).cast("long").alias("twice"))).write.mode(
        "append").parquet(f"{folder}/target")
    assert spark.read.parquet(f"{folder}/target").count() == 1003


def test_sealing_removes_what_no_batch_has_committed(spark, folder):
    spark.range(10).repartition(2).write.parquet(f"{folder}/staged")
    args = (spark, f"{folder}/staged", f"{folder}/target", lambda df: df, 2, 1000, lambda *_: None)
    sealed, kept = load.seal, []
    try:
        def stray(session, target):
            spark.range(5).write.mode("append").parquet(f"{folder}/other")
            source = [f for f in os.listdir(f"{folder}/other") if f.endswith(".parquet")][0]
            os.link(f"{folder}/other/{source}", f"{target}/part-stray.parquet")
            kept.append(len(os.listdir(target)))
            sealed(session, target)
        load.seal = stray
        load.stream_load(*args)
    finally:
        load.seal = sealed
    assert not os.path.exists(f"{folder}/target/part-stray.parquet")
    assert spark.read.parquet(f"{folder}/target").count() == 10


def test_a_failing_load_raises(spark, folder):
    spark.range(10).write.parquet(f"{folder}/staged")
    with pytest.raises(Exception, match="no such row"):
        load.stream_load(
            spark, f"{folder}/staged", f"{folder}/target",
            lambda df: df.select(F.raise_error(F.lit("no such row")).alias("x")), 1, 1, lambda *_: None,
        )


def test_the_ledger_of_a_run_has_growing_samples(spark, folder):
    tables = Tables(spark, f"{DATA}/sf0.001")
    job = Migration(spark, "r", f"{folder}/target", f"{folder}/stage", f"{folder}/ledger")
    names = ("lineitem", "orders", "region")
    for n in names:
        job.add_table(TablePlan(n, tables.raw(n), strategy="staged"))
    assert [r["matched"] for r in job.run().collect()] == [True] * 3
    events = read_ledger(spark, f"{folder}/ledger")
    samples = progress.parsed(events.filter("kind = 'bytes_progress'"), "table", "bytes_done", "total_bytes")
    rates = {r["id"]: r["rate"] for r in progress.bytes_rate(events).collect()}
    for n in names:
        own = samples.filter(F.col("table") == n).orderBy("id").collect()
        done = [r["bytes_done"] for r in own]
        assert len(done) >= 3 and done[0] == 0 and sorted(set(done)) == done, n
        assert done[-1] == own[0]["total_bytes"]
        assert all(rates[r["id"]] > 0 for r in own[1:])
    # In the middle of the first load its rate and time left are known.
    middle = samples.filter("table = 'lineitem'").orderBy("id").collect()[2]["id"]
    part = events.filter(F.col("id") <= middle)
    states = progress.run_tables(part, progress.registered_totals(part))
    row = progress.kpis(part, states, progress.run_states(part, F.lit("2099-01-01").cast("timestamp"))).first()
    assert row["active_mode"] == "bytes" and row["inst"] > 0 and row["eta_sec"] > 0


def test_tables_with_a_given_strategy_are_counted_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            seen.add(len(row))
            yield row

    source = spark.range(20).mapInPandas(count, "id long")
    job = Migration(spark, "r", f"{folder}/target", f"{folder}/stage")
    job.add_table(TablePlan("t", source, strategy="direct")).run()
    assert seen.value == 20


def test_engine_time_lies_within_wall_time(spark):
    def slow():
        import time
        time.sleep(0.3)
        return spark.range(100_000).groupBy((F.col("id") % 7).alias("k")).count()

    rows = compare.bench_run(spark, [("a", slow, lambda: spark.range(7)), ("b", None, slow)])
    a, b = rows.orderBy("query_n").collect()
    assert 0 < a["source_ms"] <= a["source_wall_ms"] - 300 and 0 < a["target_ms"] <= a["target_wall_ms"]
    assert 0 <= a["source_planning_ms"] < a["source_wall_ms"] and (a["source_rows"], a["target_rows"]) == (7, 7)
    assert b["source_ms"] is None and b["source_wall_ms"] is None and b["target_ms"] > 0
    over = compare.wall_overhead(rows, 250, "source").orderBy("query_n").collect()
    assert over[0]["source_overhead_ms"] >= 300 and over[1]["source_overhead_ms"] is None
