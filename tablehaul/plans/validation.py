"""Validation of damaged copies of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul import fixed_values as fv
from tablehaul.catalog import Tables
from tablehaul.operators import align, validate
from tablehaul.operators.validate import TableCheck
from tablehaul.registry import query

LOADED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

CHECKED = {
    "orders": ("o_totalprice", "o_orderdate", ["o_custkey", "o_orderdate"]),
    "lineitem": ("l_extendedprice", "l_shipdate", ["l_orderkey", "l_shipdate"]),
    "customer": ("c_acctbal", None, ["c_name", "c_mktsegment"]),
}


def facts(t: Tables) -> DataFrame:
    """Both sides of the checked tables, and of one table neither side has."""
    checks = [
        TableCheck(
            name, lambda n=name: getattr(t, n)(), lambda n=name: t.copied(n),
            sum_column, time_column, required,
        )
        for name, (sum_column, time_column, required) in CHECKED.items()
    ]
    checks.append(TableCheck("part", t.part, t.part, "p_retailprice", None, ["p_name"]))
    return validate.compare_tables(t.spark, checks)


def facts_with_missing(t: Tables) -> DataFrame:
    missing = TableCheck("partsupp", lambda: t.raw("partsupp"), lambda: t.raw("partsupp"))
    checks = [
        TableCheck(n, lambda n=n: getattr(t, n)(), lambda n=n: t.copied(n))
        for n in [*CHECKED, "part"]
    ]
    return validate.compare_tables(t.spark, [*checks, missing])


FACTS_SQL = """
    WITH facts AS (
      SELECT 'orders' AS table_name, * FROM
        (SELECT count(*) AS sr, sum(o_totalprice) AS ss, min(o_orderdate) AS s0,
                max(o_orderdate) AS s1, count(*) FILTER (WHERE o_custkey IS NULL)
                + count(*) FILTER (WHERE o_orderdate IS NULL) AS sn FROM orders_v),
        (SELECT count(*) AS tr, sum(o_totalprice) AS ts, min(o_orderdate) AS t0,
                max(o_orderdate) AS t1, count(*) FILTER (WHERE o_custkey IS NULL)
                + count(*) FILTER (WHERE o_orderdate IS NULL) AS tn FROM orders_copy)
      UNION ALL SELECT 'lineitem', * FROM
        (SELECT count(*), sum(l_extendedprice), min(l_shipdate), max(l_shipdate),
                count(*) FILTER (WHERE l_orderkey IS NULL)
                + count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem_v) a,
        (SELECT count(*), sum(l_extendedprice), min(l_shipdate), max(l_shipdate),
                count(*) FILTER (WHERE l_orderkey IS NULL)
                + count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem_copy) b
      UNION ALL SELECT 'customer', * FROM
        (SELECT count(*), sum(c_acctbal), NULL, NULL, count(*) FILTER (WHERE c_name IS NULL)
                + count(*) FILTER (WHERE c_mktsegment IS NULL) FROM customer_v) a,
        (SELECT count(*), sum(c_acctbal), NULL, NULL, count(*) FILTER (WHERE c_name IS NULL)
                + count(*) FILTER (WHERE c_mktsegment IS NULL) FROM customer_copy) b
      UNION ALL SELECT 'part', * FROM
        (SELECT count(*), sum(p_retailprice), NULL, NULL, count(*) FILTER (WHERE p_name IS NULL)
         FROM part_v) a,
        (SELECT count(*), sum(p_retailprice), NULL, NULL, count(*) FILTER (WHERE p_name IS NULL)
         FROM part_v) b)"""
SUM_OK = "abs(ss - ts) <= CAST(0.0001 AS DECIMAL(5,4)) * abs(ss)"
RANGE_OK = "s0 IS NOT DISTINCT FROM t0 AND s1 IS NOT DISTINCT FROM t1"

PARITY_SQL = FACTS_SQL + """, parity AS (
      SELECT table_name, sr AS source_rows, tr AS target_rows, sr = tr AS matched,
             CAST(NULL AS VARCHAR) AS error FROM facts
      UNION ALL SELECT 'partsupp', NULL, NULL, false,
             'source: PATH_NOT_FOUND | target: PATH_NOT_FOUND')"""


@query("row_count_parity", PARITY_SQL + " SELECT * FROM parity")
def row_count_parity(t: Tables) -> DataFrame:
    return validate.row_count_parity(facts_with_missing(t))


@query("validation_summary", PARITY_SQL + """
    SELECT count(*) FILTER (WHERE matched AND error IS NULL) AS matched,
           count(*) FILTER (WHERE NOT matched AND error IS NULL) AS mismatched,
           count(*) FILTER (WHERE error IS NOT NULL) AS errored, count(*) AS total FROM parity""")
def validation_summary(t: Tables) -> DataFrame:
    return validate.validation_summary(row_count_parity(t))


@query("sum_parity", FACTS_SQL + f"""
    SELECT table_name, CAST(ss AS DOUBLE) AS source_sum, CAST(ts AS DOUBLE) AS target_sum,
           {SUM_OK} AS matched FROM facts""")
def sum_parity(t: Tables) -> DataFrame:
    return validate.sum_parity(facts(t))


@query("range_parity", FACTS_SQL + f"""
    SELECT table_name, CAST(s0 AS TIMESTAMP) AS source_first, CAST(s1 AS TIMESTAMP) AS source_last,
           CAST(t0 AS TIMESTAMP) AS target_first, CAST(t1 AS TIMESTAMP) AS target_last,
           {RANGE_OK} AS matched FROM facts""")
def range_parity(t: Tables) -> DataFrame:
    return validate.range_parity(facts(t))


@query("null_parity", FACTS_SQL + """
    SELECT table_name, sn AS source_nulls, tn AS target_nulls, tn = 0 AS matched FROM facts""")
def null_parity(t: Tables) -> DataFrame:
    return validate.null_parity(facts(t))


@query("validation_report", FACTS_SQL + f"""
    SELECT table_name, sr AS source_rows, tr AS target_rows, sr = tr AS rows_match,
           {SUM_OK} AS sum_match, {RANGE_OK} AS range_match, tn AS target_nulls FROM facts""")
def validation_report(t: Tables) -> DataFrame:
    return validate.validation_report(facts(t))


COUNTS_SQL = " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, count(*) AS "rows" FROM {n}""" for n in LOADED
)


@query("union_counts", COUNTS_SQL)
def union_counts(t: Tables) -> DataFrame:
    return validate.union_counts({n: t.raw(n) for n in LOADED})


@query("expected_rows_check", f"""
    WITH counts AS ({COUNTS_SQL}),
    expected AS (SELECT unnest({list(fv.SF1_ROWS)}) AS table_name,
                        unnest({list(fv.SF1_ROWS.values())}) AS expected_rows)
    SELECT e.table_name, CAST(expected_rows AS BIGINT) AS expected_rows, "rows" AS actual_rows,
           "rows" IS NOT DISTINCT FROM expected_rows AS matched
    FROM expected e LEFT JOIN counts c ON e.table_name = c.table_name""")
def expected_rows_check(t: Tables) -> DataFrame:
    return validate.expected_rows_check(union_counts(t), fv.SF1_ROWS)


@query("result_compare", """
    WITH s AS (SELECT o_orderdate, o_orderpriority, count(*) AS orders FROM orders_v GROUP BY ALL),
    c AS (SELECT o_orderdate, o_orderpriority, count(*) AS orders FROM orders_copy
          WHERE o_orderstatus <> 'P' OR o_orderdate < DATE '2001-07-20' GROUP BY ALL)
    SELECT 'source' AS only_in, CAST(1 AS BIGINT) AS surplus, * FROM (FROM s EXCEPT ALL FROM c)
    UNION ALL SELECT 'target', 1, * FROM (FROM c EXCEPT ALL FROM s)""")
def result_compare(t: Tables) -> DataFrame:
    """Daily counts of the source against a copy that also lost some late cancelled orders."""
    def daily(orders: DataFrame) -> DataFrame:
        return orders.groupBy("o_orderdate", "o_orderpriority").agg(
            F.count(F.lit(1)).alias("orders")
        )

    copy = t.copied("orders").filter("o_orderstatus <> 'P' OR o_orderdate < DATE'2001-07-20'")
    return validate.result_compare(daily(t.orders()), daily(copy))


@query("result_compare_tolerant", """
    WITH s AS (SELECT l_partkey AS part_key, sum(l_extendedprice) AS revenue FROM lineitem_v
               GROUP BY 1),
    c AS (SELECT l_partkey AS part_key, sum(l_extendedprice) AS revenue FROM lineitem_copy
          GROUP BY 1)
    SELECT part_key, 'differs' AS difference FROM s JOIN c USING (part_key)
    WHERE abs(s.revenue::DOUBLE - c.revenue::DOUBLE) > abs(s.revenue::DOUBLE) * 0.000004""")
def result_compare_tolerant(t: Tables) -> DataFrame:
    def revenue(lines: DataFrame) -> DataFrame:
        return lines.groupBy(F.col("l_partkey").alias("part_key")).agg(
            F.sum("l_extendedprice").alias("revenue")
        )

    return validate.result_compare_tolerant(
        revenue(t.lineitem()), revenue(t.copied("lineitem")), ["part_key"], {"revenue": 0.000004}
    )


@query("result_compare_unkeyed", """
    WITH s AS (SELECT l_returnflag, l_shipdate, l_quantity, l_extendedprice * 1.0 AS price FROM lineitem_v),
    -- Noise is far below the tolerance, and what is changed lies far above it.
    changed AS (SELECT l_returnflag, l_shipdate, l_quantity, price FROM s
                WHERE l_quantity = 7 AND l_returnflag = 'R')
    SELECT 'source' AS only_in, l_returnflag, CAST(count(*) AS BIGINT) AS "rows" FROM changed GROUP BY 2
    UNION ALL SELECT 'target', l_returnflag, count(*) FROM changed GROUP BY 2""")
def result_compare_unkeyed(t: Tables) -> DataFrame:
    """Lines without their keys against a copy with rounding noise and some prices of the other sign."""
    lines = t.lineitem().select(
        "l_returnflag", "l_shipdate", "l_quantity", F.col("l_extendedprice").cast("double").alias("price")
    )
    noise = F.lit(1.0) + (F.pmod(F.xxhash64("l_shipdate", "price"), F.lit(7)) - 3) * 1e-12
    changed = (F.col("l_quantity") == 7) & (F.col("l_returnflag") == "R")
    copy = lines.withColumn("price", F.when(changed, -F.col("price")).otherwise(F.col("price") * noise))
    found = align.result_compare_unkeyed(lines, copy, {"price": 1e-9})
    return found.groupBy("only_in", "l_returnflag").agg(F.sum("surplus").alias("rows"))


@query("row_hash_compare", """
    SELECT coalesce(s.l_orderkey, c.l_orderkey) AS l_orderkey,
           coalesce(s.l_linenumber, c.l_linenumber) AS l_linenumber, 'changed' AS difference
    FROM (SELECT l_orderkey, l_linenumber, bool_or(l_returnflag = 'R') AS hit
          FROM lineitem_v GROUP BY ALL) s
    JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem_copy) c
      ON s.l_orderkey = c.l_orderkey AND s.l_linenumber = c.l_linenumber
    WHERE hit""")
def row_hash_compare(t: Tables) -> DataFrame:
    return validate.row_hash_compare(
        t.lineitem(), t.copied("lineitem"), ["l_orderkey", "l_linenumber"]
    )
