"""Tables of which a batch rewrites only what it touches."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tablehaul.operators.change import cdc_apply
from tablehaul.operators.rollup import Rollup, rollup_build, rollup_merge
from tablehaul.session import work_tables
from tablehaul.sources import layout
from tablehaul.sources.buckets import GONE, BucketedTable, buckets_for
from tablehaul.sources.states import compact_folders
from tablehaul.streaming import jobs

CHANGE = "k long, g string, x long, v long, op string"


def files_below(path):
    return {
        os.path.relpath(os.path.join(d, f), path)
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


@pytest.fixture
def stored(spark, folder):
    tables = []

    def make(rows, keys=("k",), buckets=8):
        name = f"t_{uuid.uuid4().hex[:8]}"
        table = BucketedTable(spark, name, f"{folder}/{name}", list(keys), "v").create(rows, buckets)
        tables.append(table)
        return table

    yield make
    for t in tables:
        t.drop()


def base_rows(spark, n=40):
    rows = [(i, "a" if i % 2 else None, i * 10, i % 3) for i in range(n)]
    rows += [(None, "a", 1, 1), (7, "b", 70, None)]
    return spark.createDataFrame(rows, "k long, g string, x long, v long")


def random_changes(seed, n=300):
    rnd = random.Random(seed)
    return [(
        rnd.choice([None, *range(60)]), rnd.choice(["a", "b", None]), rnd.randrange(5),
        rnd.choice([None, 0, 1, 2, 3, 4]), rnd.choice("UUID"),
    ) for _ in range(n)]


def shown(df):
    return sorted(map(str, (tuple(r[c] for c in ("k", "g", "x", "v")) for r in df.collect())))


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_equal_one_application(spark, stored, seed):
    base, rows = base_rows(spark), random_changes(seed)
    want = shown(cdc_apply(base, spark.createDataFrame(rows, CHANGE), ["k", "g"], "v", "op"))
    table = stored(base, ["k", "g"])
    random.Random(seed).shuffle(rows)
    for at in range(0, len(rows), 100):
        part = spark.createDataFrame(rows[at:at + 100], CHANGE)
        table.apply(part, "op")
        table.apply(part, "op")  # a batch that runs again changes nothing
    assert shown(table.read()) == want


def test_an_older_change_does_not_bring_a_deleted_key_back(spark, stored):
    table = stored(base_rows(spark), ["k", "g"])
    for version, op in ((9, "D"), (5, "U"), (9, "U")):
        table.apply(spark.createDataFrame([(3, "a", 1, version, op)], CHANGE), "op")
        assert table.read().filter("k = 3").count() == 0
    table.apply(spark.createDataFrame([(3, "a", 1, 10, "U")], CHANGE), "op")
    assert table.read().filter("k = 3").first()["x"] == 1


def test_a_change_to_one_key_rewrites_one_bucket(spark, stored):
    table = stored(spark.range(1000).selectExpr("id AS k", "id AS x", "1L AS v"))
    before = files_below(table.path)
    touched = table.apply(spark.createDataFrame([(5, 99, 2, "U")], "k long, x long, v long, op string"), "op")
    after = files_below(table.path)
    assert len(touched) == 1 and table.buckets == 8
    assert {f.split("/")[0] for f in before ^ after} == {f"bucket={touched[0]}"}
    assert table.read().count() == 1000 and table.read().filter("k = 5").first()["x"] == 99


def scans_below(node, name, exchanged=False):
    """For every scan of a table: whether it reads rows without key only, and whether an exchange
    stands above it."""
    own, text = node.nodeName(), node.toString()
    if own.startswith("Scan") and name in text:
        yield "DataFilters: [isnull(" in text, exchanged
    children = node.children()
    for i in range(children.size()):
        yield from scans_below(children.apply(i), name, exchanged or "Exchange" in own)


def test_the_table_is_not_shuffled_to_its_changes(spark, stored):
    table = stored(spark.range(1000).selectExpr("id AS k", "id AS x", "1L AS v"))
    changes = spark.createDataFrame([(5, 99, 2, "U")], "k long, x long, v long, op string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {c: spark.conf.get(c) for c in settings}
    try:
        for c, v in settings.items():
            spark.conf.set(c, v)
        merged = table.merged(changes, "op")
        found = list(scans_below(merged._jdf.queryExecution().executedPlan(), table.name))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    # Only rows whose key is NULL are shuffled.
    assert sorted(found) == [(False, False), (False, False), (True, True), (True, True)]


def test_no_change_and_no_row(spark, stored):
    table = stored(spark.createDataFrame([], "k long, x long, v long"))
    none = spark.createDataFrame([], "k long, x long, v long, op string")
    assert table.apply(none, "op") == [] and table.read().collect() == []
    table.apply(spark.createDataFrame([(1, 2, None, "I")], none.schema), "op")
    assert [tuple(r) for r in table.read().collect()] == [(1, 2, None)]
    assert GONE not in table.read().columns and buckets_for(0) == 8 and buckets_for(10**12) > 20_000


def test_a_stream_applies_its_batches_to_the_table(spark, folder, stored):
    base, rows = base_rows(spark), random_changes(3)
    changes = spark.createDataFrame(rows, CHANGE)
    changes.repartition(3).write.parquet(f"{folder}/in")
    table = stored(base, ["k", "g"])
    source = jobs.read_files(spark, f"{folder}/in", files_per_batch=1)
    jobs.stream_cdc_table(source, table, "op", f"{folder}/checkpoint").awaitTermination()
    assert shown(table.read()) == shown(cdc_apply(base, changes, ["k", "g"], "v", "op"))


# ---- folders --------------------------------------------------------------------------------

SPEC = Rollup(["day", "kind"], counts={"n": "1"}, sums={"total": "value"}, distincts={"users": "user"})
ROW = "day date, kind string, value long, user long"


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def facts(spark, days, n=3):
    return spark.createDataFrame(
        [(d, "ab"[i % 2], i, i % 5) for d in days for i in range(n)], ROW
    )


def test_only_days_with_repeated_keys_are_folded(spark, folder):
    path = f"{folder}/states"
    rollup_build(facts(spark, [day(i) for i in range(6)]), SPEC).write.partitionBy("day").parquet(path)
    again = facts(spark, [day(2), day(4), None])
    for _ in range(2):
        rollup_build(again, SPEC).write.mode("append").partitionBy("day").parquet(path)
    before, want = files_below(path), sorted(map(tuple, rollup_merge(spark.read.parquet(path), SPEC).collect()), key=str)
    assert sorted(compact_folders(spark, path, SPEC, "day"), key=str) == [day(2), day(4), None]
    after, states = files_below(path), spark.read.parquet(path)
    changed = {f.split("/")[0] for f in before ^ after}
    assert changed == {"day=2024-01-03", "day=2024-01-05", "day=__HIVE_DEFAULT_PARTITION__"}
    assert states.count() == states.select("day", "kind").distinct().count() == 14
    assert sorted(map(tuple, rollup_merge(states, SPEC).collect()), key=str) == want
    assert compact_folders(spark, path, SPEC, "day") == [] and files_below(path) == after


def test_folded_decimals_keep_the_type_of_the_table(spark, folder):
    spec = Rollup(["day"], {"n": "1"}, {"total": "x"}, {"mean": "x"})
    rows = spark.range(6).selectExpr("concat('d', id % 3) AS day", "CAST(id + 0.25 AS DECIMAL(12,2)) AS x")
    path = f"{folder}/states"
    rollup_build(rows, spec).write.partitionBy("day").parquet(path)
    rollup_build(rows.filter("day = 'd1'"), spec).write.mode("append").partitionBy("day").parquet(path)
    assert compact_folders(spark, path, spec, "day") == ["d1"]
    kinds = {tuple(spark.read.parquet(f"{path}/day=d{i}").dtypes) for i in range(3)}
    assert len(kinds) == 1 and dict(kinds.pop())["total"] == "decimal(22,2)"
    got = {r["day"]: (r["n"], float(r["total"])) for r in spark.read.parquet(path).collect()}
    assert got == {"d0": (2, 3.5), "d1": (4, 11.0), "d2": (2, 7.5)}


def test_a_batch_that_touches_one_day_writes_one_day(spark, folder):
    root, source = f"{folder}/refresh", f"{folder}/in"

    def run(df):
        df.coalesce(1).write.mode("append").parquet(source)
        jobs.stream_refresh_lagged(
            jobs.read_files(spark, source), SPEC, root, f"{folder}/checkpoint", lag=None, folder=F.col("day")
        ).awaitTermination()

    parts = [facts(spark, [day(i) for i in range(10)]), facts(spark, [day(3)]), facts(spark, [day(20), None])]
    run(parts[0])
    first = layout.newest_folders(spark, f"{root}/table")
    run(parts[1])
    second = layout.newest_folders(spark, f"{root}/table")
    assert first.keys() == second.keys() and {f for f in first if first[f] != second[f]} == {"2024-01-04"}
    data = [d for d in os.listdir(f"{root}/table") if d.startswith("data-1-")]
    assert len(data) == 1 and len({f.split("/")[0] for f in files_below(f"{root}/table/{data[0]}")}) == 1
    run(parts[2])
    everything = parts[0].unionByName(parts[1]).unionByName(parts[2])
    want = sorted(map(tuple, rollup_merge(rollup_build(everything, SPEC), SPEC).collect()), key=str)
    assert sorted(map(tuple, jobs.read_refreshed(spark, root).collect()), key=str) == want


def test_many_batches_leave_two_versions(spark, folder):
    """Each batch touches one of five days; what no kept version holds is deleted."""
    root = f"{folder}/many"
    spec = Rollup(["day"], counts={"n": "1"})
    schema = rollup_build(facts(spark, [day(0)]), spec).schema
    for version in range(20):
        own = str(day(version % 5))
        with work_tables(spark):
            old = layout.read_folders(spark, root, schema, below=version, only=[own])
            new = spark.createDataFrame([(day(version % 5), 1)], schema).unionByName(old)
            states = rollup_merge(new, spec).withColumn(layout.FOLDER, F.col("day").cast("string"))
            layout.replace_folders(states, root, version, [own])
        layout.drop_folders(spark, root)
    assert len(layout.newest_folders(spark, root)) == 5 and len(files_below(root)) <= 6 + 2
    got = layout.read_folders(spark, root, schema)
    assert sorted(map(tuple, got.collect())) == [(day(i), 4) for i in range(5)]


def test_versions_of_folders(spark, folder):
    schema = "a long, b string"
    assert layout.newest_folders(spark, folder) == {}
    assert layout.read_folders(spark, folder, spark.createDataFrame([], schema).schema).collect() == []

    def write(version, rows, touched):
        df = spark.createDataFrame(rows, f"{schema}, _folder string")
        layout.replace_folders(df, folder, version, touched)

    def read(below=None):
        df = layout.read_folders(spark, folder, spark.createDataFrame([], schema).schema, below)
        return sorted(map(tuple, df.collect()))

    write(0, [(1, "x", "p/q=1"), (2, "y", "é")], ["p/q=1", "é"])
    write(1, [(3, "z", "é")], ["é"])
    write(1, [(4, "z", "é")], ["é"])  # again
    assert read() == [(1, "x"), (4, "z")] and read(below=1) == [(1, "x"), (2, "y")]
    write(2, [], ["p/q=1"])  # a folder that lost all rows
    assert read() == [(4, "z")]
    write(3, [], ["é"])
    assert read() == []
