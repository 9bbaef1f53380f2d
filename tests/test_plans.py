"""Physical plans: what must reach the scan, and what must not appear at all."""

import pytest
from pyspark.sql import functions as F

from tablehaul.operators import augment, profile
from tablehaul.operators.change import latest_changes
from tablehaul.operators.ordered import running_total
from tablehaul.operators.rollup import Rollup, rollup_build
from tablehaul.registry import all_queries
from tablehaul.session import fit_shuffles
from tablehaul.sources import slices
from tests.parity import DATA

SF = f"{DATA}/sf0.001"
QUERIES = all_queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_products(spark, key):
    if key.startswith("stream_") or key in ("bench_run", "multi_table_migrate"):
        pytest.skip("runs its jobs while it is built")
    text = plan(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("key,filters", [
    ("op_sargable_range", "GreaterThanOrEqual(o_orderdate,1996-06-01"),
    ("op_filter_between", "LessThan(o_orderdate,1996-01-01"),
    ("wh_part_revenue", "GreaterThanOrEqual(l_shipdate,1995-01-01"),
    ("ec_segment_category", "GreaterThanOrEqual(o_orderdate,2001-05-04"),
    ("op_filter_time_window", "GreaterThanOrEqual(ts,2024-01-24"),
    ("web_attribution", "GreaterThanOrEqual(ts,2024-01-01"),
    ("web_device_matrix", "GreaterThanOrEqual(ts,2024-01-01"),
    ("web_geo", "GreaterThanOrEqual(ts,2024-01-01"),
    ("web_utm_roi", "GreaterThanOrEqual(ts,2024-01-01"),
    ("web_entry_exit", "GreaterThanOrEqual(ts,2024-01-01"),
])
def test_filters_reach_the_scan(spark, key, filters):
    scan = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    text = QUERIES[key](spark, SF)._sc._jvm.PythonSQLUtils.explainString(
        QUERIES[key](spark, SF)._jdf.queryExecution(), "formatted"
    )
    assert filters in scan or filters in text


def test_scan_reads_only_what_it_needs(spark):
    text = plan(QUERIES["wh_top_customers"](spark, SF))
    assert "o_orderpriority" not in text and "c_acctbal" not in text


@pytest.mark.parametrize("key", [
    "ec_topn_category", "op_window_rank", "op_qualify", "prog_batch_rate", "prog_milestones",
])
def test_top_n_is_trimmed_before_the_shuffle(spark, key):
    text = plan(QUERIES[key](spark, SF))
    assert "Partial" in text.split("WindowGroupLimit", 1)[1]


def test_large_groups_are_cut_into_slots(spark):
    df = spark.range(1000).select(F.lit("a").alias("k"), "id", F.lit(1).alias("v"))
    result = running_total(df, ["k"], "id", "v", "total", slot_rows=100)
    assert result.agg(F.max("total")).first()[0] == 1000


def test_shuffles_grow_with_the_input(spark):
    name, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    try:
        fit_shuffles(spark, 10)
        assert spark.conf.get(name) == before
        fit_shuffles(spark, 10**12)
        assert int(spark.conf.get(name)) > 20_000
        fit_shuffles(spark, 10**14)
        assert int(spark.conf.get(name)) > 2_000_000
        fit_shuffles(spark, 10)
        assert spark.conf.get(name) == before
    finally:
        spark.conf.set(name, before)


def test_one_distinct_count_expands_no_row(spark):
    assert "Expand" not in plan(QUERIES["web_utm_roi"](spark, SF))


def test_sessions_are_built_once(spark):
    assert plan(QUERIES["web_new_vs_returning"](spark, SF)).count("FileScan") == 1


def test_estimated_profile_is_one_scan(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    assert plan(profile.column_profile(df, df.columns, exact=False)).count("FileScan") == 1


def test_slices_are_made_in_many_tasks(spark):
    text = plan(slices.plan_key_slices(spark.range(1000), "id", 10))
    assert "Range (" in text and "Generate" not in text


def test_sample_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(augment.hash_sample(spark.range(100), "id", 5))


@pytest.mark.parametrize("batch", ["rollup", "changes"])
def test_batches_of_streams_combine_before_the_shuffle(spark, batch):
    if batch == "rollup":
        df = rollup_build(spark.range(9).selectExpr("'a' AS g", "id AS v"), Rollup(["g"], sums={"s": "v"}))
    else:
        rows = spark.range(9).selectExpr("id AS k", "id AS v", "'U' AS op")
        df = latest_changes(rows, ["k"], "v", "op")
    text = plan(df)
    assert "partial_" in text and "CartesianProduct" not in text and "Window" not in text
