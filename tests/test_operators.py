"""Operators on small hand-made frames: NULLs, ties, repeated keys, DST, zero divisors."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablehaul import types
from tablehaul.functions import scalars
from tablehaul.operators import augment, compare, conform, joins, profile, progress, validate
from tablehaul.operators.change import cdc_apply, dedup_latest
from tablehaul.operators.rollup import Rollup, rollup_build, rollup_compact, rollup_merge
from tablehaul.operators.series import gap_fill
from tablehaul.registry import all_queries
from tests.parity import DATA


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- types and conforming ----------------------------------------------------


@pytest.mark.parametrize("dialect,source,want", [
    ("snowflake", "NUMBER(12,2)", "decimal(12,2)"), ("snowflake", "NUMBER(9, 0)", "int"),
    ("snowflake", "NUMBER", "decimal(38,0)"), ("snowflake", "TIMESTAMP_TZ", "timestamp"),
    ("bigquery", "NUMERIC", "decimal(38,9)"), ("bigquery", "ARRAY<INT64>", "array<bigint>"),
    ("postgres", "TEXT[]", "array<string>"), ("postgres", "double precision", "double"),
    ("columnar", "UInt64", "decimal(20,0)"), ("columnar", "DateTime64(3, 'UTC')", "timestamp"),
    ("columnar", "LowCardinality(String)", "string"), ("columnar", "Nullable(Int32)", "int"),
    ("columnar", "LowCardinality(Nullable(String))", "string"),
    ("columnar", "Array(Nullable(Decimal(12, 2)))", "array<decimal(12,2)>"),
    ("columnar", "Map(LowCardinality(String), Array(UInt8))", "map<string,array<smallint>>"),
    ("columnar", "Enum8('a,b' = 1, 'c)' = 2)", "string"), ("columnar", "Decimal64(4)", "decimal(18,4)"),
    ("columnar", "Tuple(a Int8, b Nullable(String))", "struct<`a`:tinyint,`b`:string>"),
    ("columnar", "Tuple(Int8, Date)", "struct<`_1`:tinyint,`_2`:date>"),
    ("columnar", "Nested(k String, v Float64)", "array<struct<`k`:string,`v`:double>>"),
    ("columnar", "DateTime('UTC')", "timestamp"), ("columnar", "DateTime", "timestamp_ntz"),
    ("bigquery", "STRUCT<a INT64, b ARRAY<STRUCT<c STRING(9), d NUMERIC(10,2)>>>",
     "struct<`a`:bigint,`b`:array<struct<`c`:string,`d`:decimal(10,2)>>>"),
    ("bigquery", "ARRAY<STRUCT<x FLOAT64>>", "array<struct<`x`:double>>"),
    ("snowflake", "STRING", "string"), ("snowflake", "TEXT", "string"),
    ("snowflake", "INTEGER", "decimal(38,0)"), ("snowflake", "VARCHAR(16777216)", "string"),
    ("postgres", "timestamp with time zone", "timestamp"),
    ("postgres", "timestamp(3) without time zone", "timestamp_ntz"),
    ("postgres", "character varying(20)", "string"), ("postgres", "numeric(10,2)[]", "array<decimal(10,2)>"),
    ("postgres", "int4", "int"),
])
def test_type_mapping(dialect, source, want):
    assert types.spark_type(dialect, source) == want


@pytest.mark.parametrize("dialect,source", [
    ("bigquery", "BIGNUMERIC(60,5)"), ("postgres", "BOX"), ("columnar", "Array(Point3)"),
    ("bigquery", "STRUCT<a NOPE>"), ("snowflake", ""),
])
def test_unsupported_types(dialect, source):
    with pytest.raises(types.UnsupportedType):
        types.spark_type(dialect, source)


def test_conform_pads_and_parses(spark):
    df = spark.createDataFrame(
        [("ab  ", "12.345", '{"a":1}', dt.datetime(2024, 1, 1, 9, 8, 7))],
        "c string, n string, j string, t timestamp_ntz",
    )
    out = conform.conform_types(
        df, {"c": "CHAR(4)", "n": "NUMBER(5,2)", "j": "VARIANT", "t": "TIME"}, "snowflake"
    ).select("c", F.col("n").cast("string"), F.variant_get("j", "$.a", "int"), "t")
    assert tuple(out.first()) == ("ab", "12.35", 1, "09:08:07")


def test_conform_intervals_and_instants(spark):
    df = spark.range(1).select(
        F.expr("INTERVAL '1 00:00:01.5' DAY TO SECOND").alias("i"),
        F.lit("2024-01-01 00:00:00.123456").cast("timestamp").alias("t"),
    )
    row = conform.conform_types(df, {"i": "INTERVAL", "t": "TIMESTAMP"}, "bigquery").first()
    assert (row.i, row.t.microsecond) == (86_401_500_000, 123_000)


def test_fk_inclusion_on_text_keys(spark):
    child = spark.createDataFrame([("a",), ("b",)], "c string")
    parent = spark.createDataFrame([("a",)], "p string")
    assert profile.fk_inclusion({"x": (child, "c", parent, "p")}).first().matched_keys == 1


def test_case_fold_collision(spark):
    df = spark.range(1).select(F.lit(1).alias("A"), F.lit(2).alias("a"))
    with pytest.raises(ValueError):
        conform.case_fold_columns(df)


def test_fill_defaults(spark):
    df = spark.createDataFrame(
        [(None, None, None, None)], "s string, d decimal(6,2), b boolean, t timestamp_ntz"
    )
    row = conform.fill_defaults(df, ["s", "d", "b", "t"]).first()
    assert (row.s, str(row.d), row.b, row.t) == ("", "0.00", False, dt.datetime(1970, 1, 1))


def test_arrays(spark):
    df = spark.createDataFrame([(["a", None],), ([],), (None,)], "tags array<string>")
    assert [r[0] for r in df.select(conform.clean_array_nulls(F.col("tags"))).collect()] == [
        ["a", ""], [], None
    ]
    kind = "struct<line:string,city:string>"
    structs = spark.createDataFrame([([("l", "c")],), (None,)], f"a array<{kind}>")
    out = structs.select(
        conform.array_struct_conform(F.col("a"), {"city": "string", "line": "string"}, kind)
    )
    assert [[tuple(x) for x in r[0]] for r in out.collect()] == [[("c", "l")], []]


def test_json_default_and_hot_keys(spark):
    df = spark.createDataFrame([('{"k":"x"}',), (None,)], "j string")
    got = df.select(F.variant_get(conform.json_default(F.col("j")), "$.k", "string"))
    assert [r[0] for r in got.collect()] == ["x", None]
    assert [r.k for r in conform.json_hot_keys(df, "j", {"k": ("$.k", "int")}).collect()] == [
        None, None
    ]


def test_row_transform_batches(spark):
    def double(batches):
        for pdf in batches:
            yield pdf.assign(n=pdf["n"] * 2)

    df = spark.range(3).select(F.col("id").alias("n"))
    out = conform.row_transform(df, {"n": F.col("n") + 1}, double, "n bigint")
    assert values(out) == [(2,), (4,), (6,)]


def test_append_columns_needs_a_match(spark):
    with pytest.raises(ValueError):
        conform.append_columns(spark.range(1), spark.createDataFrame([], "x int").schema)


# ---- scalars -------------------------------------------------------------------


def test_new_york_midnight_follows_daylight_saving(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 7, 5),)], "d date")
    hours = [r[0].hour for r in df.select(augment.delivery_at("d")).collect()]
    assert hours == [5, 4]


def test_hour_distances(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 50), dt.datetime(2024, 1, 1, 2, 10))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    b, a = F.col("b"), F.col("a")
    row = df.select(
        scalars.hours_whole(b, a), scalars.hour_boundaries(b, a), scalars.hours_exact(b, a)
    ).first()
    assert (row[0], row[1]) == (1, 2)
    assert row[2] == pytest.approx(4 / 3)


def test_month_distances(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 1), dt.date(2024, 1, 1))], "b date, a date")
    row = df.select(
        scalars.month_boundaries(F.col("b"), F.col("a")),
        scalars.months_wrapping(F.col("b"), F.col("a")),
    ).first()
    assert tuple(row) == (14, 2)


def test_map_text_and_ratio(spark):
    df = spark.createDataFrame([({"a": "x"}, 1, 0), ({}, 1, 4)], "m map<string,string>, p int, w int")
    got = df.select(scalars.map_text("m", "a"), scalars.ratio_pct(F.col("p"), F.col("w"), 1))
    assert [tuple(r) for r in got.collect()] == [("x", None), ("", 25.0)]


def test_gap_fill_ends(spark):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(at, 5)], "h timestamp_ntz, n int")
    end = at + dt.timedelta(hours=2)
    closed = gap_fill(df, "h", at, end, "1 hour", {"n": 0})
    assert [r.n for r in closed.orderBy("h").collect()] == [5, 0, 0]
    assert gap_fill(df, "h", at, end, "1 hour", {"n": 0}, inclusive_end=False).count() == 2


# ---- joins and samples -----------------------------------------------------------


def test_left_join_many_equals_left_join(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (9, "d")], "k int, v string")
    assert values(joins.left_join_many(left, right, ["k"])) == values(left.join(right, "k", "left"))


def test_broadcast_checked_leaves_large_tables_alone(spark):
    df = spark.range(100)
    size = joins.estimated_bytes(df)
    assert "broadcast" in joins.broadcast_checked(df, size)._jdf.queryExecution().toString().lower()
    assert joins.broadcast_checked(df, size - 1) is df


def test_hash_sample_cut_changes_nothing(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    full = df.orderBy(F.md5("k"), "k").limit(50)
    assert values(augment.hash_sample(df, "k", 50)) == values(full)
    assert augment.hash_sample(df, "k", 5000).count() == 1000


def test_missing_grid(spark):
    keys = spark.createDataFrame([(1,), (2,)], "p int")
    have = spark.createDataFrame([(1, "x")], "p int, w string")
    out = augment.missing_grid(keys, {"w": F.array(F.lit("x"), F.lit("y"))}, have)
    assert values(out) == [(1, "y"), (2, "x"), (2, "y")]

def test_missing_grid_joins_keys_and_never_broadcasts_rows(spark, folder):
    keys = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, j string")
    rows = [(1, "a", "x", 0), (1, "a", "x", 0), (1, "a", "y", 69), (1, "a", "z", 1), (1, "a", "x", 70),
            (2, None, "x", 0), (3, "c", None, 1), (3, "c", "x", 62), (3, "b", "x", 63), (3, "c", "y", None)]
    spark.createDataFrame(rows, "k int, j string, w string, n long").write.parquet(folder + "/have")
    have = spark.read.parquet(folder + "/have")  # a table of known, small size
    axes = {"w": F.array(*[F.lit(v) for v in ("x", "y", None, "x")]), "n": F.sequence(F.lit(0), F.lit(69))}
    out = augment.missing_grid(keys, axes, have)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    grid = keys.withColumn("w", F.explode(axes["w"])).withColumn("n", F.explode(axes["n"]))
    want = grid.join(have, grid.columns, "left_anti")
    assert out.columns == want.columns and out.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    assert out.count() == 4 * 4 * 70 - 2 * 3 - 2


# ---- profiling --------------------------------------------------------------------


def test_profile_and_types(spark):
    df = spark.createDataFrame([(1, "a", -5), (300, None, 7)], "n bigint, s string, i int")
    p = profile.column_profile(df, ["n", "s", "i"])
    got = {r.column_name: r for r in p.collect()}
    assert (got["s"].rows, got["s"].non_null, got["s"].distinct_values) == (2, 1, 1)
    types_ = {r.column_name: (r.target_type, r.nullable) for r in profile.suggest_types(p).collect()}
    assert types_ == {
        "n": ("UInt16", False), "s": ("LowCardinality(String)", True), "i": ("Int8", False)
    }


def test_array_homogeneity(spark):
    df = spark.createDataFrame([('[1, 2]',), ('[3, "x"]',), (None,)], "j string")
    got = {r.element_type: r.elements for r in profile.array_homogeneity(df, F.col("j")).collect()}
    assert got == {"BIGINT": 3, "STRING": 1}


def test_fk_inclusion_ignores_null_children(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "c int")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "p int")
    row = profile.fk_inclusion({"c->p": (child, "c", parent, "p")}).first()
    assert (row.child_keys, row.matched_keys, row.child_rows, row.share) == (2, 1, 3, 0.5)


# ---- validation --------------------------------------------------------------------


def test_result_compare_counts_duplicates(spark):
    s = spark.createDataFrame([(1,), (1,), (None,), (2,)], "x int")
    t = spark.createDataFrame([(1,), (None,), (2,), (3,)], "x int")
    assert values(validate.result_compare(s, t)) == [("source", 1, 1), ("target", 1, 3)]
    assert validate.result_compare(s, s).count() == 0


def test_row_hash_compare(spark):
    schema = "k int, a string, b string"
    s = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "z", "z"), (None, "n", "n"),
                               (5, "d", "1"), (5, "d", "2")], schema)
    t = spark.createDataFrame([(1, "x", None), (2, None, "y"), (4, "z", "z"), (None, "n", "n"),
                               (5, "d", "2"), (5, "d", "1")], schema)
    assert values(validate.row_hash_compare(s, t, ["k"])) == [
        (1, "changed"), (2, "changed"), (3, "missing"), (4, "extra")
    ]


def test_tolerant_compare(spark):
    s = spark.createDataFrame([(1, 100.0), (2, 100.0), (3, None)], "k int, v double")
    t = spark.createDataFrame([(1, 100.005), (2, 101.0), (4, 1.0)], "k int, v double")
    assert values(validate.result_compare_tolerant(s, t, ["k"], {"v": 0.0001})) == [
        (2, "differs"), (3, "missing"), (4, "extra")
    ]


def test_one_bad_table_does_not_stop_the_rest(spark, folder):
    good = spark.range(3)
    checks = [
        validate.TableCheck("good", lambda: good, lambda: good),
        validate.TableCheck("bad", lambda: good, lambda: spark.read.parquet(f"{folder}/none")),
    ]
    facts = validate.compare_tables(spark, checks)
    got = {r.table_name: r for r in validate.row_count_parity(facts).collect()}
    assert got["good"].matched and got["good"].error is None
    assert not got["bad"].matched and got["bad"].error.startswith("target:")
    done = spark.createDataFrame([("good",)], "table_name string")
    assert validate.compare_tables(spark, checks, done).count() == 1


# ---- rollups, dedup, changes -----------------------------------------------------------

SPEC = Rollup(
    ["g"], counts={"n": "1"}, sums={"s": "v"}, averages={"a": "v"}, distincts={"u": "u"},
    quantiles={"q": ("v", 0.5)},
)


def test_rollup_is_the_same_however_it_is_cut(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), rnd.randrange(100), rnd.randrange(2000), rnd.randrange(4))
            for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, v int, u int, part int")
    states = None
    for i in range(4):
        one = rollup_build(df.filter(f"part = {i}"), SPEC)
        states = one if states is None else states.unionByName(one)
    exact = {
        r.g: r for r in df.groupBy("g").agg(
            F.count("*").alias("n"), F.sum("v").alias("s"), F.avg("v").alias("a"),
            F.count_distinct("u").alias("u"), F.percentile("v", 0.5).alias("q"),
        ).collect()
    }
    for merged in (rollup_merge(states, SPEC), rollup_merge(rollup_compact(states, SPEC), SPEC)):
        for r in merged.collect():
            e = exact[r.g]
            assert (r.n, r.s) == (e.n, e.s) and r.a == pytest.approx(e.a)
            assert abs(r.u - e.u) <= 0.05 * e.u
            assert abs(r.q - e.q) <= 5


def test_dedup_latest(spark):
    df = spark.createDataFrame([(1, 1, "old"), (1, 3, "new"), (1, 2, "mid"), (None, 1, "n")],
                               "k int, v int, x string")
    assert values(dedup_latest(df, ["k"], ["v"])) == [(1, 3, "new"), (None, 1, "n")]


def test_cdc_ignores_order_and_repeats(spark):
    base = spark.createDataFrame(
        [(1, "a", 1), (2, "b", 5), (3, "c", 1), (None, "n", 1)], "k int, x string, v int"
    )
    changes = [(1, "a2", 2, "U"), (1, "a3", 3, "U"), (2, "late", 4, "D"), (3, "", 2, "D"),
               (4, "new", 1, "U"), (5, "gone", 1, "U"), (5, "gone", 2, "D"),
               (None, "n2", 9, "U")]
    want = [(1, "a3", 3), (2, "b", 5), (4, "new", 1), (None, "n2", 9)]
    for seed in range(3):
        mixed = changes * 2
        random.Random(seed).shuffle(mixed)
        df = spark.createDataFrame(mixed, "k int, x string, v int, op string")
        assert values(cdc_apply(base, df, ["k"], "v", "op")) == want


def test_estimates_stay_within_their_bounds(spark):
    queries, sf = all_queries(), f"{DATA}/sf0.01"

    def column(key, name, by="event_type"):
        return {r[by]: r[name] for r in queries[key](spark, sf).collect()}

    for key in ("op_uniq_approx", "rollup_uniq_state"):
        estimated, exact = column(key, "users"), column("op_count_distinct", "users")
        assert all(abs(estimated[k] - exact[k]) <= 0.05 * exact[k] for k in exact)
    exact = queries["op_percentile_exact"](spark, sf).collect()
    values = queries["op_percentile_approx"](spark, sf).collect()
    middle = column("rollup_quantile_state", "median_value")
    for e in exact:
        a = next(r for r in values if r.event_type == e.event_type)
        assert abs(a.p50 - e.p50) <= 0.02 * e.p50 and abs(a.p99 - e.p99) <= 0.02 * e.p99
        assert abs(middle[e.event_type] - e.p50) <= 0.05 * e.p50
    daily = column("web_daily_traffic", "unique_visitors", "date")
    truth = column("web_daily_traffic_exact", "unique_visitors", "date")
    assert all(abs(daily[k] - truth[k]) <= 0.05 * truth[k] for k in truth)


# ---- ledger and benchmarks -----------------------------------------------------------------


def ledger(spark, rows):
    return spark.createDataFrame(
        [(i, "r", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), kind, payload)
         for i, s, kind, payload in rows],
        "id bigint, run_id string, ts timestamp_ntz, kind string, payload_json string",
    )


def test_bytes_rate_resets(spark):
    events = ledger(spark, [
        (1, 0, "bytes_progress", '{"table":"a","bytes_done":100}'),
        (2, 2, "bytes_progress", '{"table":"a","bytes_done":300}'),
        (3, 3, "bytes_progress", '{"table":"b","bytes_done":900}'),
        (4, 4, "log", '{}'),
        (5, 5, "bytes_progress", '{"table":"b","bytes_done":800}'),
        (6, 6, "table_done", '{"table":"b"}'),
        (7, 7, "bytes_progress", '{"table":"b","bytes_done":900}'),
        (8, 7, "bytes_progress", '{"table":"b","bytes_done":990}'),
    ])
    got = {r.id: r.rate for r in progress.bytes_rate(events).collect()}
    assert got == {1: 0, 2: 100, 3: 0, 5: 0, 7: 0, 8: 0}


def test_batch_rate_guards_zero_seconds(spark):
    events = ledger(spark, [(1, 0, "batch_done", '{"rows":5,"seconds":2}'),
                            (2, 1, "batch_done", '{"rows":5,"seconds":0}')])
    assert {r.id: r.rate for r in progress.batch_rate(events).collect()} == {1: 3, 2: 0}


def test_milestones_drop_noise(spark):
    events = ledger(spark, [
        (1, 0, "started", '{"source_type":"pg","target_database":"db"}'),
        (2, 1, "batch_done", '{"rows":5}'),
        (3, 2, "phase_started", '{"table":"t","phase":"unloading"}'),
        (4, 3, "phase_started", '{"table":"t","phase":"other"}'),
        (5, 4, "table_done", '{"table":"t","total_rows":12345}'),
        (6, 5, "failed", '{"error":"boom"}'), (7, 6, "paused", '{}'),
    ])
    got = {r.id: (r.tag, r.tone, r.message) for r in progress.milestones(events).collect()}
    assert got == {
        1: ("start", "info", "Run started · pg → db"),
        3: ("unload", "start", "t · unloading to S3"),
        5: ("done", "done", "t complete · 12,345 rows"),
        6: ("fail", "fail", "Failed · boom"), 7: ("pause", "pause", "Paused at batch boundary"),
    }
    assert [r.id for r in progress.milestones(events, 1).collect()] == [7]


def test_speedup_and_flags(spark):
    rows = spark.createDataFrame(
        [(1, 10.0, 0.0, None), (2, 10.0, 20.0, None), (3, 10.0, 5.0, None), (4, 10.0, 1.0, None),
         (5, 10.0, None, "x")],
        "query_n int, source_ms double, target_ms double, target_error string",
    ).withColumn("source_error", F.lit(None).cast("string"))
    assert {r.query_n: r.flag for r in compare.slow_flags(rows).collect()} == {
        2: "target slower", 3: "weak speedup"
    }
    s = compare.bench_summary(rows, []).first()
    assert (s.queries, s.completed) == (5, 4)
    assert s.avg_speedup == pytest.approx((0.5 + 2 + 10) / 3)


def test_bench_run_keeps_errors(spark):
    def broken():
        return spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))

    rows = compare.bench_run(spark, [("a", lambda: spark.range(3), broken), ("b", None, None)])
    a, b = rows.orderBy("query_n").collect()
    assert a.source_rows == 3 and a.source_ms > 0 and a.target_ms is None and a.target_error
    assert b.source_ms is None and b.source_error is None
