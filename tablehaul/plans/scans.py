"""Scans, staging, layouts and whole migrations on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablehaul import fixed_values as fv
from tablehaul.catalog import Tables, date_lit
from tablehaul.functions.scalars import yyyymm
from tablehaul.registry import query
from tablehaul.session import work_path
from tablehaul.sources import files, layout, slices
from tablehaul.sources.migrate import Migration, TablePlan

ALL_TABLES = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events"]
DIMENSIONS = ["region", "nation", "supplier", "customer", "part"]
SLICE_IDS = 10_000


@query("scan_query", """
    SELECT o_orderkey, o_orderdate, c_mktsegment FROM orders_v JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'F'""")
def scan_query(t: Tables) -> DataFrame:
    return files.scan_query(
        t.spark,
        "SELECT o_orderkey, o_orderdate, c_mktsegment FROM {orders} JOIN {customer} "
        "ON o_custkey = c_custkey WHERE o_orderstatus = 'F'",
        orders=t.orders(), customer=t.customer(),
    )


@query("count_rows", """SELECT count(*) AS "rows" FROM lineitem""")
def count_rows(t: Tables) -> DataFrame:
    return files.count_rows(t.raw("lineitem"))


@query("scan_pipe_delimited", """
    SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment
    FROM customer_v""")
def scan_pipe_delimited(t: Tables) -> DataFrame:
    """Customers written in the delimited exchange format and read back."""
    path = work_path(t.spark, "customer.tbl")
    customers = t.customer()
    files.write_pipe_delimited(customers, path)
    read = files.read_pipe_delimited(t.spark, path, customers.schema)
    return read.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


#: How customers are written by key: whole, without end, short, with a word for the balance, with
#: a further field, and with a quote in the name, which is ordinary text there.
LINE_FORMS = ["whole", "no end", "short", "word", "long", "quote"]


@query("scan_pipe_rejects", """
    SELECT outcome, CAST(count(*) AS BIGINT) AS "rows", CAST(sum(c_custkey) AS BIGINT) AS keys,
           CAST(sum(balance) AS DOUBLE) AS balance
    FROM (SELECT c_custkey, CASE c_custkey % 6 WHEN 2 THEN '3 fields instead of 5'
                   WHEN 3 THEN 'c_acctbal: ''n/a'' is no decimal(12,2)'
                   WHEN 4 THEN '6 fields instead of 5' ELSE 'row' END AS outcome,
                 CASE WHEN c_custkey % 6 IN (0, 1, 5) THEN c_acctbal END AS balance
          FROM customer_v) GROUP BY outcome""")
def scan_pipe_rejects(t: Tables) -> DataFrame:
    """Lines of several forms read without quoting: rows, and a table of rejected lines."""
    root = work_path(t.spark, "customer-lines")
    customers = t.customer().select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"),
        "c_mktsegment",
    )
    form = F.element_at(F.array(*map(F.lit, LINE_FORMS)), (F.col("c_custkey") % 6 + 1).cast("int"))
    text = {c: F.col(c).cast("string") for c in customers.columns}
    name = F.when(form == "quote", F.concat(F.lit('"'), text["c_name"])).otherwise(text["c_name"])
    balance = F.when(form == "word", "n/a").otherwise(text["c_acctbal"])
    head = F.concat_ws("|", text["c_custkey"], name, text["c_nationkey"])
    line = (
        F.when(form == "short", F.concat(head, F.lit("|")))
        .when(form == "no end", F.concat_ws("|", head, balance, "c_mktsegment"))
        .when(form == "long", F.concat_ws("|", head, balance, "c_mktsegment", F.lit("more|")))
        .otherwise(F.concat_ws("|", head, balance, "c_mktsegment", F.lit("")))
    )
    customers.select(line).write.text(f"{root}/lines")
    rows = files.read_pipe_delimited(
        t.spark, f"{root}/lines", customers.schema, quote="", rejects=f"{root}/rejects"
    )
    bad = t.spark.read.parquet(f"{root}/rejects")
    key = F.split("line", r"\|")[0].cast("long")
    both = rows.select(F.lit("row").alias("outcome"), "c_custkey", "c_acctbal").unionByName(
        bad.select(F.col("reason").alias("outcome"), key.alias("c_custkey")), allowMissingColumns=True
    )
    return both.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("c_custkey").alias("keys"),
        F.sum("c_acctbal").cast("double").alias("balance"),
    )


def _slices_sql(view: str, key: str, with_rows: bool) -> str:
    return f"""
    WITH b AS (SELECT min({key}) AS lo, max({key}) AS hi FROM {view}),
    plan AS (SELECT unnest(range(lo, hi + 1, {SLICE_IDS})) AS first, lo, hi FROM b)
    SELECT CAST((first - lo) // {SLICE_IDS} AS INTEGER) AS slice, first,
           least(first + {SLICE_IDS} - 1, hi) AS last""" + (f""",
           CAST((SELECT count(*) FROM {view} WHERE {key} BETWEEN first
                 AND least(first + {SLICE_IDS} - 1, hi)) AS BIGINT) AS "rows" """
        if with_rows else "") + " FROM plan"


@query("scan_plan_bounds", _slices_sql("orders", "o_orderkey", False))
def scan_plan_bounds(t: Tables) -> DataFrame:
    return slices.plan_key_slices(t.raw("orders"), "o_orderkey", SLICE_IDS).drop("lowest", "highest")


@query("scan_jdbc_range", _slices_sql("lineitem", "l_orderkey", True))
def scan_jdbc_range(t: Tables) -> DataFrame:
    """The key ranges a JDBC read would use, and the rows each of them holds."""
    return slices.slice_rows(t.raw("lineitem"), "l_orderkey", SLICE_IDS)


@query("scan_month_slices", """
    SELECT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month,
           CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS from_date,
           CAST(date_trunc('month', min(o_orderdate)) + INTERVAL 1 MONTH AS DATE) AS to_date,
           CAST(count(*) AS BIGINT) AS "rows" FROM orders_v GROUP BY 1""")
def scan_month_slices(t: Tables) -> DataFrame:
    return slices.month_slices(t.orders(), "o_orderdate")


@query("stage_export")
def stage_export(t: Tables) -> DataFrame:
    return files.stage_export(t.lineitem(), work_path(t.spark, "stage"), "run-1", "lineitem")


@query("stage_load", """
    SELECT CAST(count(*) FILTER (WHERE o_orderdate < DATE '1998-01-01') AS BIGINT) AS rows_before,
           CAST(count(*) FILTER (WHERE o_orderdate >= DATE '1998-01-01') AS BIGINT) AS rows_done,
           CAST(count(*) AS BIGINT) AS rows_after FROM orders_v""")
def stage_load(t: Tables) -> DataFrame:
    """The later years are staged and loaded into a target that holds the earlier ones."""
    root = work_path(t.spark, "stage-load")
    split = F.col("o_orderdate") < date_lit("1998-01-01")
    t.orders().filter(split).write.mode("overwrite").parquet(f"{root}/target")
    files.stage_export(t.orders().filter(~split), root, "run-1", "orders")
    staged = files.stage_path(root, "run-1", "orders")
    return files.stage_load(t.spark, f"{staged}/*.parquet", f"{root}/target")


@query("append_conformed", """
    SELECT c_custkey, c_name, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_nationkey END
             AS c_nationkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment
    FROM customer_v""")
def append_conformed(t: Tables) -> DataFrame:
    """The second part has other letter case, an unknown column and a missing one."""
    target = work_path(t.spark, "append")
    first = F.col("c_mktsegment") != "FURNITURE"
    t.customer().filter(first).write.mode("overwrite").parquet(target)
    second = t.customer().filter(~first).select(
        F.col("c_mktsegment").alias("C_MKTSEGMENT"), F.col("c_acctbal").alias("C_AcctBal"),
        F.col("c_custkey").alias("C_CUSTKEY"), F.col("c_name").alias("C_Name"),
        F.lit("ignored").alias("C_COMMENT"),
    )
    files.append_conformed(second, target)
    read = t.spark.read.parquet(target)
    return read.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


MONTHS_SQL = """
    SELECT CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS ym, CAST(count(*) AS BIGINT) AS "rows",
           CAST(sum(l_extendedprice) AS DOUBLE) AS revenue FROM lineitem_v"""


def by_month(lines: DataFrame) -> DataFrame:
    return lines.groupBy("ym").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("l_extendedprice").cast("double").alias("revenue")
    )


@query("write_partition_sorted", MONTHS_SQL + """
    WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1997-01-01' GROUP BY 1""")
def write_partition_sorted(t: Tables) -> DataFrame:
    """Lines in month folders; one year is read back through the folder filter."""
    path = work_path(t.spark, "lineitem-by-month")
    layout.write_partition_sorted(t.lineitem(), path, "l_shipdate", ["l_orderkey", "l_linenumber"])
    year = layout.month_filter("l_shipdate", "1996-01-01", "1997-01-01")
    return by_month(t.spark.read.parquet(path).filter(year))


@query("swap_rebuild", MONTHS_SQL + " GROUP BY 1")
def swap_rebuild(t: Tables) -> DataFrame:
    """An unsorted catalog table gets files by month and key under the same name."""
    name = f"lines_{uuid.uuid4().hex[:8]}"
    root = work_path(t.spark, "swap")
    t.lineitem().write.mode("overwrite").parquet(f"{root}/{name}-first")
    t.spark.catalog.createTable(name, path=f"{root}/{name}-first", source="parquet")
    rebuilt = layout.swap_rebuild(
        t.spark, name, root,
        lambda df, path: layout.write_partition_sorted(
            df, path, "l_shipdate", ["l_orderkey"], folders=False
        ),
    )
    return by_month(rebuilt.withColumn("ym", yyyymm("l_shipdate")))


@query("table_inventory")
def table_inventory(t: Tables) -> DataFrame:
    return files.table_inventory(t.spark, {n: t.path(n) for n in ALL_TABLES})


@query("multi_table_migrate", " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name,
        CASE WHEN count(*) > {fv.STAGE_ROWS_THRESHOLD} OR '{n}' = 'lineitem'
             THEN 'staged' ELSE 'direct' END AS strategy,
        count(*) AS source_rows, count(*) AS target_rows, true AS matched, 'done' AS status,
        CAST(NULL AS VARCHAR) AS error FROM {n}""" for n in ALL_TABLES))
def multi_table_migrate(t: Tables) -> DataFrame:
    """All tables copied: lines through the stage, the others by row count."""
    root = work_path(t.spark, "migration")
    job = Migration(t.spark, "run-1", f"{root}/target", f"{root}/stage")
    for n in ALL_TABLES:
        source = getattr(t, n)() if n in ("orders", "lineitem", "customer", "part") else t.raw(n)
        job.add_table(TablePlan(
            n, source, target_schema=StructType(source.schema.fields),
            strategy="staged" if n == "lineitem" else "auto", dimension=n in DIMENSIONS,
        ))
    return job.run()
