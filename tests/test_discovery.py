"""Keys, roles and column use; digests of buckets; comparisons in one job and without keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablehaul.operators import align, discover, progress, validate
from tablehaul.operators.validate import TableCheck
from tablehaul.sources import ledger
from tests.test_plans import plan


def tables(spark):
    dims = spark.range(1, 41).selectExpr("id AS k", "concat('name', id) AS name", "id % 3 AS g")
    facts = spark.range(4000).selectExpr(
        "id AS f", "id % 40 + 1 AS dim", "CAST(id % 40 + 1 AS INT) AS small", "id % 45 AS almost",
        "concat('name', id % 40 + 1) AS who", "CAST(NULL AS INT) AS nothing", "1.5D AS price",
    )
    groups = spark.range(3).selectExpr("id AS g", "CAST(id AS STRING) AS text")
    return {"facts": facts, "dims": dims, "groups": groups}


def test_keys_and_roles(spark):
    got = {tuple(r) for r in discover.foreign_keys(tables(spark)).collect()}
    assert got == {
        ("facts", "dim", "dims", "k", 1.0, "fact", "both"),
        ("facts", "small", "dims", "k", 1.0, "fact", "both"),
        ("facts", "who", "dims", "name", 1.0, "fact", "both"),
        ("dims", "g", "groups", "g", 1.0, "both", "dimension"),
    }


def test_signatures_take_one_scan_per_table(spark, folder):
    own = tables(spark)
    for name, df in own.items():
        df.write.parquet(f"{folder}/{name}")
    stored = {n: spark.read.parquet(f"{folder}/{n}") for n in own}
    found = discover.signatures(stored)
    assert plan(found).count("FileScan") == 3
    pairs = {tuple(r) for r in discover.candidate_keys(found).collect()}
    assert ("facts", "dim", "dims", "k") in pairs and not any(c in ("almost", "nothing") for _, c, _, _ in pairs)


def test_no_keys_at_all(spark):
    one = {"a": spark.range(5).selectExpr("0 AS x"), "b": spark.range(3).selectExpr("1.5D AS y")}
    assert discover.foreign_keys(one).collect() == []


def test_column_use_follows_aliases_and_roles(spark, folder):
    spark.range(9).selectExpr("id AS a", "id AS b", "id AS c", "id AS d", "id AS e").write.parquet(f"{folder}/t")
    spark.range(9).selectExpr("id AS x").write.parquet(f"{folder}/u")
    t, u = spark.read.parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/u")
    renamed = t.select((F.col("a") + F.col("b")).alias("s"), F.col("c").alias("z"), "d")
    one = renamed.filter("s > 3").join(u, F.col("z") == F.col("x")).groupBy("d").count().filter("count > 1")
    assert set(discover.plan_column_use(one)) == {
        ("a", "filter"), ("b", "filter"), ("c", "join"), ("x", "join"), ("d", "group"),
    }
    use = discover.column_use([one, t.filter("a = 1").filter("a < 9"), t.select("e")], t)
    assert {tuple(r) for r in use.collect()} == {("a", 2, 0, 0), ("b", 1, 0, 0), ("c", 0, 1, 0), ("d", 0, 0, 1)}


def rows(spark, n=2000):
    return spark.range(n).selectExpr(
        "id AS k", "id % 7 AS a", "IF(id % 5 = 0, NULL, CAST(id AS STRING)) AS b", "IF(id % 3 = 0, NULL, 1) AS c"
    )


def test_equal_tables_shuffle_no_row(spark):
    compared = validate.row_hash_compare(rows(spark), rows(spark).repartition(3), ["k"])
    text = plan(compared)
    assert "Exchange" not in text and "Range" not in text and compared.collect() == []
    assert compared.columns == ["k", "difference"]


@pytest.mark.parametrize("buckets", [1, 8, 1 << 16])
def test_damaged_rows_are_found_through_their_buckets(spark, buckets):
    source = rows(spark)
    target = source.filter("k <> 11").withColumn("a", F.when(F.col("k") == 12, 99).otherwise(F.col("a")))
    # A NULL that moves to another column, a repeated row, and a key that is new.
    target = target.withColumn("c", F.when(F.col("k") == 13, None).otherwise(F.col("c"))).unionByName(
        source.filter("k = 14")).unionByName(source.filter("k = 15").withColumn("k", F.lit(-1).cast("long")))
    got = {tuple(r) for r in validate.row_hash_compare(source, target, ["k"], buckets).collect()}
    assert got == {(11, "missing"), (12, "changed"), (13, "changed"), (14, "changed"), (-1, "extra")}
    found = validate.differing_buckets(source, target, ["k"], buckets)
    assert len(found) <= 5 and validate.differing_buckets(source, source, ["k"], buckets) == []


def test_a_damaged_file_spoils_only_its_own_row(spark, folder):
    rows(spark).write.parquet(f"{folder}/good")
    rows(spark).write.parquet(f"{folder}/bad")
    schema = spark.read.parquet(f"{folder}/bad").schema
    with open(f"{folder}/bad/part-broken.parquet", "w") as out:
        out.write("no parquet")

    def good():
        return spark.read.parquet(f"{folder}/good")

    checks = [
        TableCheck("good", good, good, "a", None, ["b"]),
        TableCheck("bad", good, lambda: spark.read.schema(schema).parquet(f"{folder}/bad")),
        TableCheck("gone", lambda: spark.read.parquet(f"{folder}/none"), good),
    ]
    got = {r["table_name"]: r for r in validate.row_count_parity(validate.compare_tables(spark, checks)).collect()}
    assert got["good"]["matched"] and got["good"]["source_rows"] == 2000 and got["good"]["error"] is None
    assert got["bad"]["source_rows"] == 2000 and got["bad"]["error"].startswith("target: ")
    assert got["gone"]["target_rows"] == 2000 and got["gone"]["error"] == "source: PATH_NOT_FOUND"


def test_a_validation_leaves_its_summary_in_the_ledger(spark, folder):
    def checks(target):
        return [TableCheck("t", lambda: spark.range(5), lambda: spark.range(target)),
                TableCheck("u", lambda: spark.range(2), lambda: spark.range(2))]

    book = ledger.Ledger(spark, f"{folder}/ledger", "r")
    parity = validate.row_count_parity(validate.compare_tables(spark, checks(5)))
    assert ledger.record_validation(parity, book, True) == {"matched": 2, "mismatched": 0, "errored": 0, "total": 2}
    parity = validate.row_count_parity(validate.compare_tables(spark, checks(4)))
    assert ledger.record_validation(parity, book)["mismatched"] == 1
    with pytest.raises(ledger.ValidationFailed, match="1 tables differ, 0 failed"):
        ledger.record_validation(parity, book, raise_on_mismatch=True)
    events = ledger.read_ledger(spark, f"{folder}/ledger")
    kinds = [r["kind"] for r in events.orderBy("id").collect()]
    assert kinds == ["validation_row", "validation_row", "validation_done", "step_validated"] * 3
    assert progress.milestones(events).filter("kind = 'step_validated'").count() == 3


# ---- without keys ----------------------------------------------------------------------------

COLUMNS = "name string, x double, y double"


def unkeyed(spark, source, target, **options):
    frames = (spark.createDataFrame(r, COLUMNS) for r in (source, target))
    found = align.result_compare_unkeyed(*frames, {"x": 1e-6, "y": 1e-6}, **options)
    return sorted(((r["only_in"], r["surplus"], r["name"], r["x"], r["y"]) for r in found.collect()), key=str)


@pytest.mark.parametrize("slot_rows", [1, 3, 500_000])
def test_noise_in_repeated_rows_matches(spark, slot_rows):
    rnd = random.Random(2)
    source = [(rnd.choice("abc"), rnd.choice([0.0, -5.0, 1e9, 3.25]) * k, 7.0) for k in range(1, 30)] * 2
    noisy = [(n, x * (1 + rnd.uniform(-4e-7, 4e-7)), y * (1 + 3e-7)) for n, x, y in source]
    rnd.shuffle(noisy)
    assert unkeyed(spark, source, noisy, slot_rows=slot_rows) == []
    changed = [*source, ("a", 100.0, 1.0), ("z", None, 1.0), ("z", float("nan"), 1.0), ("a", 50.0, 1.0)]
    copy = [*noisy, ("a", 100.1, 1.0), ("z", float("nan"), 1.0), ("a", 50.0, 2.0), ("z", 0.0, 1.0)]
    assert unkeyed(spark, changed, copy, slot_rows=slot_rows) == sorted([
        ("source", 1, "a", 100.0, 1.0), ("target", 1, "a", 100.1, 1.0), ("source", 1, "z", None, 1.0),
        ("source", 1, "a", 50.0, 1.0), ("target", 1, "a", 50.0, 2.0), ("target", 1, "z", 0.0, 1.0),
    ], key=str)


def test_surplus_copies_are_counted(spark):
    source, target = [("a", 1.0, 1.0)] * 5, [("a", 1.0 + 1e-9, 1.0)] * 3
    assert unkeyed(spark, source, target) == [("source", 2, "a", 1.0, 1.0)]
    assert unkeyed(spark, [], target) == [("target", 3, "a", 1.0 + 1e-9, 1.0)]
    assert unkeyed(spark, [], []) == []


def test_clusters_inside_a_partition_are_paired_where_they_lie(spark, monkeypatch):
    """Only clusters at the ends of partitions, and very long ones, are dealt once more."""
    source = [("ab"[i % 2], 10.0 * (i + 1), 1.0) for i in range(200)]
    target = [(n, x * (1 + 4e-7), y) for n, x, y in source[1:]] + [("c", 1.0, 1.0)]
    counts, real = [], align.saved

    def counted(df, name, **options):
        stored = real(df, name, **options)
        if name == "clusters":
            counts.append(stored.count())
        return stored

    monkeypatch.setattr(align, "saved", counted)
    want = [("source", 1, *source[0]), ("target", 1, *target[-1])]
    assert unkeyed(spark, source, target, slot_rows=100) == want
    assert counts.pop() <= 2 + 2 * 4 * 2  # of 400 rows


@pytest.mark.parametrize("held_rows", [0, 1, 5, 100_000])
def test_clusters_of_any_length_are_paired_alike(spark, held_rows):
    rnd = random.Random(5)
    source = [(rnd.choice("ab"), k * 1000.0 + rnd.randrange(8) * 4e-4, rnd.choice([1.0, 2.0]))
              for k in range(1, 9) for _ in range(rnd.randrange(1, 30))]
    target = [(n, x + rnd.randrange(3) * 2e-4, y) for n, x, y in source if rnd.random() < 0.9]
    want = unkeyed(spark, source, target, slot_rows=500_000, held_rows=100_000)
    assert unkeyed(spark, source, target, slot_rows=17, held_rows=held_rows) == want
    count = {side: sum(r[1] for r in want if r[0] == side) for side in ("source", "target")}
    assert len(source) - count["source"] == len(target) - count["target"] > 0


def test_exact_columns_of_any_kind_are_told_apart(spark):
    kinds = "a string, b string, c array<string>, d struct<p:int,q:int>, t timestamp_ntz, x double"
    at = dt.datetime(2024, 1, 1)
    rows = [("k", None, ["u", None], (1, None), at, 5.0), (None, "k", ["u"], (None, 1), at, 5.0),
            ("k", "", None, None, None, 5.0)]
    noisy = [(*r[:-1], 5.0 * (1 + 1e-9)) for r in rows]
    source = spark.createDataFrame(rows, kinds)
    assert align.result_compare_unkeyed(source, spark.createDataFrame(noisy, kinds), {"x": 1e-6}).count() == 0
    for other in ([(None, "k", *noisy[0][2:])], [("k", None, ["u"], *noisy[0][3:])],
                  [(*noisy[0][:3], (None, 1), *noisy[0][4:])], [("k", None, *noisy[2][2:])],
                  [(*noisy[0][:4], at + dt.timedelta(microseconds=1), 5.0)]):
        found = align.result_compare_unkeyed(source, spark.createDataFrame(other, kinds), {"x": 1e-6})
        assert found.count() == 4


def test_a_chain_longer_than_a_partition_is_paired_in_order(spark):
    values = [100 * (1 + 4e-7) ** i for i in range(60)]
    source, target = ([("a", v * (1 + e), 0.0) for v in values] for e in (0, 9e-7))
    assert unkeyed(spark, source, target, slot_rows=7) == []
