"""Running totals, neighbours and percentiles against brute force, hot groups included."""

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablehaul.operators.ordered import exact_percentiles, neighbour, running_total, slots_of


def rows_with_hot_key(seed=1, n=900):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None])
        # Half of the times repeat, and a few are missing.
        at = None if rnd.random() < 0.02 else start + dt.timedelta(minutes=rnd.randrange(200))
        rows.append((i, key, at, rnd.choice([None, 1, 2, 3])))
    return rows


def brute_totals(rows):
    low = dt.datetime.min
    out = {}
    for i, key, at, _ in rows:
        values = [
            v for _, k, a, v in rows
            if k == key and (a or low) <= (at or low) and v is not None
        ]
        out[i] = sum(values) if values else None
    return out


@pytest.mark.parametrize("slot_rows", [10**9, 150, 20])
def test_running_total(spark, slot_rows):
    rows = rows_with_hot_key()
    df = spark.createDataFrame(rows, "id int, key string, at timestamp_ntz, v int")
    got = running_total(df, ["key"], "at", "v", "total", slot_rows).collect()
    assert {r["id"]: r["total"] for r in got} == brute_totals(rows)
    assert len(got) == len(rows)


@pytest.mark.parametrize("slot_rows", [10**9, 150, 20])
@pytest.mark.parametrize("step", ["previous", "next"])
def test_neighbour(spark, slot_rows, step):
    rows = [(i, k, v) for i, k, _, v in rows_with_hot_key(seed=2)]
    df = spark.createDataFrame(rows, "id int, key string, v int")
    got = {
        r["id"]: r[f"{step}_v"]
        for r in neighbour(df, ["key"], "id", ["v"], step, slot_rows).collect()
    }
    want = {}
    for i, key, _ in rows:
        others = [(j, v) for j, k, v in rows if k == key and (j < i if step == "previous" else j > i)]
        pick = (max if step == "previous" else min)(others, default=(None, None))
        want[i] = pick[1]
    assert got == want


@pytest.mark.parametrize("step", ["previous", "next"])
def test_neighbours_of_tied_rows_do_not_depend_on_slots(spark, step):
    rows = [("k", i // 4, i % 3) for i in range(60)] + [("k", None, 7), ("k", None, 8)]
    df = spark.createDataFrame(rows, "key string, id int, v int")
    got = [
        sorted(map(str, neighbour(part, ["key"], "id", ["v"], step, slot_rows).collect()))
        for part in (df, df.repartition(5)) for slot_rows in (5, 1000)
    ]
    assert got[0] == got[1] == got[2] == got[3] and "_place" not in got[0][0]


@pytest.mark.parametrize("slot_rows", [10**9, 50, 20])
def test_percentiles(spark, slot_rows):
    rnd = random.Random(3)
    rows = [("x" if rnd.random() < 0.8 else None, rnd.choice([None, rnd.randrange(500) / 4]))
            for _ in range(700)]
    df = spark.createDataFrame(rows, "key string, v double")
    points = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    for r in exact_percentiles(df, ["key"], "v", points, slot_rows).collect():
        values = [v for k, v in rows if k == r["key"] and v is not None]
        assert r["n"] == len(values)
        for name, p in points.items():
            assert r[name] == pytest.approx(np.quantile(values, p))


NAN, INF = float("nan"), float("inf")
ORDERS = {
    "double": [NAN, INF, -INF, None, 0.0, -0.0, 1.5, NAN, INF],
    "string": ["b", "a", None, "", "é", "aa", "b", "Z"],
    "decimal(38,0)": [Decimal(2**53 + i) for i in (0, 1, 2, 1)] + [None, Decimal(10**30)],
    "date": [dt.date(2024, 1, i) for i in (3, 1, 2, 2)] + [None],
}


@pytest.mark.parametrize("kind", ORDERS)
def test_slots_make_no_difference(spark, kind):
    values = ORDERS[kind]
    rows = [(k, v, i) for i, v in enumerate(values * 2) for k in ("x", "y")]
    df = spark.createDataFrame(rows, f"key string, at {kind}, v int")
    one = running_total(df, ["key"], "at", "v", "total", 10**9)
    many = running_total(df, ["key"], "at", "v", "total", 3)
    assert one.schema == many.schema
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    amounts = df.withColumn("v", F.lit("0.10").cast("decimal(12,2)"))
    pair = [running_total(amounts, ["key"], "at", "v", "t", n) for n in (10**9, 3)]
    assert pair[0].schema == pair[1].schema
    assert sorted(map(str, pair[0].collect())) == sorted(map(str, pair[1].collect()))
    if kind == "double":
        got = [exact_percentiles(df, ["key"], "at", {"p25": 0.25, "p100": 1.0}, n) for n in (10**9, 3)]
        assert sorted(map(str, got[0].collect())) == sorted(map(str, got[1].collect()))


def test_slots_follow_the_rows(spark):
    assert [slots_of(spark.range(n), 10) for n in (0, 10, 11, 95)] == [1, 1, 2, 10]


def test_input_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(50).select("id", (F.col("id") % 2).alias("key")).mapInArrow(count, "id long, key long")
    assert running_total(df, ["key"], "id", "id", "total", 10).count() == 50
    assert seen.value == 50


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, key string, v int")
    assert running_total(df, ["key"], "id", "v", "t").count() == 0
    assert neighbour(df, ["key"], "id", ["v"]).count() == 0
    assert exact_percentiles(df, ["key"], "v", {"p50": 0.5}).count() == 0
