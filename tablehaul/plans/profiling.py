"""Profiling operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.catalog import Tables
from tablehaul.operators import discover, profile
from tablehaul.registry import all_queries, query

PROFILED = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
    "o_totalprice": "decimal(12,2)", "o_orderdate": "date", "o_orderpriority": "string",
}


def _profile_sql(view: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) AS "rows",
            count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values,
            CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value
            FROM {view}"""
        for c, kind in columns.items()
    )


@query("column_profile", _profile_sql("orders_v", PROFILED))
def column_profile(t: Tables) -> DataFrame:
    return profile.column_profile(t.orders(), list(PROFILED))


@query("suggest_types", f"""
    WITH p AS ({_profile_sql("customer_copy", {
        "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
        "c_acctbal": "decimal(12,2)", "c_mktsegment": "string"})})
    SELECT column_name,
           CASE WHEN data_type IN ('int', 'bigint') THEN
                  CASE WHEN TRY_CAST(max_value AS BIGINT) < 256 THEN 'UInt8'
                       WHEN TRY_CAST(max_value AS BIGINT) < 65536 THEN 'UInt16' ELSE 'UInt32' END
                WHEN data_type = 'decimal(12,2)' THEN 'Decimal(12,2)'
                WHEN distinct_values < 10000 THEN 'LowCardinality(String)' ELSE 'String' END
             AS target_type,
           non_null < "rows" AS nullable FROM p""")
def suggest_types(t: Tables) -> DataFrame:
    customers = t.copied("customer")
    return profile.suggest_types(profile.column_profile(customers, customers.columns))


@query("enum_drift", """
    SELECT event_type AS value, CAST(count(*) AS BIGINT) AS "rows" FROM events
    WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY event_type""")
def enum_drift(t: Tables) -> DataFrame:
    return profile.enum_drift(t.raw("events"), "event_type", ["view", "click", "purchase"])


@query("sample_rows", """
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders_v ORDER BY o_orderkey LIMIT 5""")
def sample_rows(t: Tables) -> DataFrame:
    return profile.sample_rows(
        t.orders().select("o_orderkey", "o_custkey", "o_orderdate"), ["o_orderkey"]
    )


@query("array_homogeneity", """
    SELECT element_type, CAST(count(*) AS BIGINT) AS elements FROM (
      SELECT 'BIGINT' AS element_type FROM events
      UNION ALL SELECT 'STRING' FROM events
      UNION ALL SELECT CASE WHEN event_type = 'click' THEN 'BOOLEAN' ELSE 'STRING' END
                FROM events) GROUP BY element_type""")
def array_homogeneity(t: Tables) -> DataFrame:
    """Arrays of a number, a text, and a flag that is itself text in most rows."""
    kind = F.col("event_type")
    flag = F.when(kind == "click", "true").otherwise('"no"')
    text = F.concat(
        F.lit("["), F.col("k"), F.lit(',"'), kind, F.lit('",'), flag, F.lit("]")
    )
    return profile.array_homogeneity(t.events(), text)


FK_PAIRS = {
    "orders.o_custkey -> customer.c_custkey": ("orders", "o_custkey", "customer", "c_custkey"),
    "lineitem.l_orderkey -> orders.o_orderkey": ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    "lineitem.l_partkey -> part.p_partkey": ("lineitem", "l_partkey", "part", "p_partkey"),
    "lineitem.l_suppkey -> supplier.s_suppkey": ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    "orders.o_orderkey -> customer.c_custkey": ("orders", "o_orderkey", "customer", "c_custkey"),
    "customer.c_nationkey -> nation.n_nationkey":
        ("customer", "c_nationkey", "nation", "n_nationkey"),
}

FK_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS pair, count(*) AS child_keys, count(p.k) AS matched_keys,
        CAST(sum(n) AS BIGINT) AS child_rows, round(count(p.k)::DOUBLE / count(*), 6) AS share,
        count(p.k) = count(*) AS is_foreign_key
        FROM (SELECT {ck} AS k, count(*) AS n FROM {child} GROUP BY 1) c
        LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {parent}) p ON c.k = p.k"""
    for name, (child, ck, parent, pk) in FK_PAIRS.items()
)


@query("fk_inclusion", FK_SQL)
def fk_inclusion(t: Tables) -> DataFrame:
    return profile.fk_inclusion({
        name: (t.raw(child), ck, t.raw(parent), pk)
        for name, (child, ck, parent, pk) in FK_PAIRS.items()
    })


#: Columns that may be keys, by table.
KEY_COLUMNS = {
    "region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"],
    "events": ["event_id", "user_id", "event_type", "props"],
}
TEXTS = ("name", "mktsegment", "brand", "type", "status", "priority", "flag", "props")


def _values_sql(table: str, column: str) -> str:
    family = "text" if column.endswith(TEXTS) else "integer"
    return f"""SELECT '{table}' AS t, '{column}' AS c, '{family}' AS f, CAST({column} AS VARCHAR) AS k,
        count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}"""


@query("fk_discovery", f"""
    WITH vals AS ({" UNION ALL ".join(_values_sql(t, c) for t, cs in KEY_COLUMNS.items() for c in cs)}),
    cols AS (SELECT t, c, count(*) AS d, max(n) AS most FROM vals GROUP BY t, c),
    pairs AS (SELECT a.t AS ct, a.c AS cc, b.t AS pt, b.c AS pc, count(*) AS shared
              FROM vals a JOIN vals b ON a.f = b.f AND a.k = b.k AND a.t <> b.t GROUP BY ALL),
    fk AS (SELECT ct, cc, pt, pc, shared / p.d AS coverage
           FROM pairs JOIN cols c ON c.t = ct AND c.c = cc JOIN cols p ON p.t = pt AND p.c = pc
           WHERE shared = c.d AND p.most = 1 AND shared / p.d >= {discover.COVERAGE}
             AND (c.most > 1 OR shared = p.d)
           QUALIFY row_number() OVER (PARTITION BY ct, cc ORDER BY coverage DESC, pt, pc) = 1),
    roles AS (SELECT t, CASE WHEN t IN (SELECT ct FROM fk) AND t IN (SELECT pt FROM fk) THEN 'both'
                             WHEN t IN (SELECT ct FROM fk) THEN 'fact' ELSE 'dimension' END AS role
              FROM (SELECT DISTINCT t FROM cols))
    SELECT ct AS child_table, cc AS child_column, pt AS parent_table, pc AS parent_column,
           round(coverage, 6) AS coverage, a.role AS child_role, b.role AS parent_role
    FROM fk JOIN roles a ON a.t = ct JOIN roles b ON b.t = pt""")
def fk_discovery(t: Tables) -> DataFrame:
    """Keys and roles of all given tables, found among all pairs of columns."""
    return discover.foreign_keys({n: t.raw(n) for n in KEY_COLUMNS})


@query("partition_sizes", """
    SELECT CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS month,
           CAST(count(*) AS BIGINT) AS "rows",
           CASE WHEN count(*) OVER () > 100 THEN 'too many' WHEN count(*) OVER () < 10 THEN 'few'
                ELSE 'ok' END AS partition_count
    FROM lineitem_v GROUP BY 1""")
def partition_sizes(t: Tables) -> DataFrame:
    return profile.partition_sizes(t.lineitem(), "l_shipdate")


@query("order_by_key_hint", """
    WITH d AS (
      SELECT 'l_returnflag' AS column_name, count(DISTINCT l_returnflag) AS distinct_values
      FROM lineitem_v
      UNION ALL SELECT 'l_shipdate', count(DISTINCT l_shipdate) FROM lineitem_v
      UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey) FROM lineitem_v
      UNION ALL SELECT 'l_orderkey', count(DISTINCT l_orderkey) FROM lineitem_v)
    SELECT CAST(row_number() OVER (ORDER BY distinct_values, column_name) AS INTEGER) AS position,
           column_name, distinct_values FROM d""")
def order_by_key_hint(t: Tables) -> DataFrame:
    return profile.sort_key_hint(
        t.lineitem(), ["l_orderkey", "l_partkey", "l_shipdate", "l_returnflag"]
    )


#: Registered queries on lines whose plans show how columns are used.
WORKLOAD = (
    "wh_delivery_latency_exact", "wh_delivery_latency_trunc", "wh_delivery_latency_boundary",
    "wh_part_revenue", "op_join_range", "op_agg_basic", "op_rollup", "op_cube",
)
#: Column, and the number of these queries that filter, join and group by it, as the SQL has it.
USED = [
    ("l_shipdate", 4, 1, 1), ("l_partkey", 0, 1, 1), ("l_orderkey", 0, 1, 1), ("l_linenumber", 0, 0, 3),
    ("l_returnflag", 0, 0, 3), ("l_linestatus", 0, 0, 2),
]


@query("order_by_key_use", f"""
    WITH d AS ({" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, {f} AS filters, {j} AS joins, {g} AS groups FROM lineitem_v"
        for c, f, j, g in USED)})
    SELECT CAST(row_number() OVER (ORDER BY distinct_values, column_name) AS INTEGER) AS position,
           column_name, distinct_values, CAST(filters AS BIGINT) AS filters,
           CAST(joins AS BIGINT) AS joins, CAST(groups AS BIGINT) AS groups FROM d""")
def order_by_key_use(t: Tables) -> DataFrame:
    """The sort key of lines from the columns that the registered queries use."""
    known = all_queries()
    use = discover.column_use([known[k].build(t) for k in WORKLOAD], t.lineitem())
    columns = [r["column_name"] for r in use.collect()]  # names only
    return profile.sort_key_hint(t.lineitem(), columns).join(use, "column_name")
