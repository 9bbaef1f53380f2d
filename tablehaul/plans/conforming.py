"""Conforming operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.catalog import Tables
from tablehaul.functions.scalars import zone_to_utc
from tablehaul.operators import conform
from tablehaul.registry import query


@query("conform_types", """
    SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS TINYINT) AS l_linenumber,
           CAST(l_partkey AS BIGINT) AS l_partkey, CAST(l_suppkey AS DOUBLE) AS supplier,
           l_linestatus, [l_returnflag] AS flags, CAST(l_quantity AS SMALLINT) AS l_quantity,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
           CAST(l_tax AS DOUBLE) AS l_tax, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate
    FROM lineitem""")
def conform_types(t: Tables) -> DataFrame:
    declared = {
        "l_orderkey": "NUMBER(18,0)", "l_linenumber": "NUMBER(2,0)", "l_partkey": "NUMBER(18,0)",
        "l_suppkey": "INTEGER", "l_linestatus": "TEXT",
        "l_quantity": "NUMBER(4,0)", "l_extendedprice": "NUMBER(12,2)", "l_tax": "FLOAT",
        "l_returnflag": "CHAR(1)", "l_shipdate": "DATE",
    }
    lines = t.raw("lineitem").withColumn("flags", F.array("l_returnflag"))
    typed = lines.select(*[
        conform.conformed(F.col(c), kind, "snowflake").alias(c) for c, kind in declared.items()
    ], conform.conformed(F.col("flags"), "Array(Nullable(String))", "columnar").alias("flags"))
    # Decimals are shown as doubles.
    shown = {"l_extendedprice": "price", "l_suppkey": "supplier"}
    return typed.select(
        *[c for c in typed.columns if c not in shown],
        *[F.col(c).cast("double").alias(name) for c, name in shown.items()],
    )


@query("case_fold_columns", """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def case_fold_columns(t: Tables) -> DataFrame:
    shouting = t.raw("customer")
    return conform.case_fold_columns(shouting.toDF(*[c.upper() for c in shouting.columns]))


@query("fill_defaults", """
    SELECT user_id, coalesce(nullif(segment, 'FURNITURE'), '') AS segment,
           coalesce(CASE WHEN lifetime_value > 0 THEN registration_date END, DATE '1970-01-01')
             AS registration_date,
           CAST(coalesce(nullif(lifetime_value, 0), 0) AS DOUBLE) AS lifetime_value,
           coalesce(CASE WHEN country_code <> 'US' THEN true END, false) AS abroad
    FROM ec_users""")
def fill_defaults(t: Tables) -> DataFrame:
    value = F.col("lifetime_value")
    with_nulls = t.ec_users().select(
        "user_id", F.nullif("segment", F.lit("FURNITURE")).alias("segment"),
        F.when(value > 0, F.col("registration_date")).alias("registration_date"),
        F.nullif(value, F.lit(0)).alias("lifetime_value"),
        F.when(F.col("country_code") != "US", True).alias("abroad"),
    )
    filled = conform.fill_defaults(
        with_nulls, ["segment", "registration_date", "lifetime_value", "abroad"]
    )
    return filled.withColumn("lifetime_value", F.col("lifetime_value").cast("double"))


@query("nested_to_json", """
    SELECT c_custkey, CAST(to_json(list({'line': line, 'city': city, 'country': country}
             ORDER BY addr_offset)) AS VARCHAR) AS addresses FROM addresses GROUP BY c_custkey""")
def nested_to_json(t: Tables) -> DataFrame:
    return t.customer_aug().select("c_custkey", F.to_json("contact_addresses").alias("addresses"))


@query("clean_array_nulls", """
    SELECT p_partkey, 3 AS n_tags,
           coalesce(nullif(p_brand, 'Brand#2'), '') || '|' || p_size || '|'
             || coalesce(nullif(p_type, 'PROMO'), '') AS tags FROM part""")
def clean_array_nulls(t: Tables) -> DataFrame:
    tags = F.array(
        F.nullif("p_brand", F.lit("Brand#2")), F.col("p_size").cast("string"),
        F.nullif("p_type", F.lit("PROMO")),
    )
    clean = conform.clean_array_nulls(tags)
    return t.part().select(
        "p_partkey", F.size(clean).alias("n_tags"), F.array_join(clean, "|").alias("tags")
    )


@query("array_struct_conform", """
    SELECT c_custkey, CAST(CASE WHEN any_value(c_mktsegment) = 'BUILDING' THEN 0 ELSE count(*) END
             AS INTEGER) AS n_addresses,
           CASE WHEN any_value(c_mktsegment) <> 'BUILDING'
                THEN max(CASE WHEN addr_offset = 0 THEN country || ':' || city END) END AS first
    FROM addresses JOIN customer USING (c_custkey) GROUP BY c_custkey""")
def array_struct_conform(t: Tables) -> DataFrame:
    fields = {"country": "string", "city": "string", "line": "string"}
    some = F.when(F.col("c_mktsegment") != "BUILDING", F.col("contact_addresses"))
    conformed = conform.array_struct_conform(
        some, fields, "struct<line:string,city:string,country:string>"
    )
    first = F.get("addresses", F.lit(0))
    return t.customer_aug().withColumn("addresses", conformed).select(
        "c_custkey", F.size("addresses").alias("n_addresses"),
        F.concat(first["country"], F.lit(":"), first["city"]).alias("first"),
    )


@query("json_default", """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN k END AS k FROM events_v""")
def json_default(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") != "error", F.col("props"))
    return t.raw("events").select(
        "event_id", F.variant_get(conform.json_default(text), "$.k", "int").alias("k")
    )


@query("json_hot_keys", """
    SELECT event_id, 'item_' || k AS label, CAST(value AS DOUBLE) AS amount FROM events_v""")
def json_hot_keys(t: Tables) -> DataFrame:
    pulled = conform.json_hot_keys(
        t.ec_events(), "properties",
        {"label": ("$.label", "string"), "amount": ("$.value", "double")},
    )
    return pulled.select("event_id", "label", "amount")


@query("struct_flatten", """
    SELECT o_orderkey, payment_method, customer_segment, order_source, shipping_expedited
    FROM orders_aug""")
def struct_flatten(t: Tables) -> DataFrame:
    return conform.struct_flatten(
        t.orders_aug("struct").select("o_orderkey", "order_metadata"), "order_metadata"
    )


@query("normalize_utc", """
    SELECT event_id, date_trunc('millisecond', (ts AT TIME ZONE 'America/New_York')
                                               AT TIME ZONE 'UTC') AS at_utc FROM events_v""")
def normalize_utc(t: Tables) -> DataFrame:
    return t.events().select("event_id", zone_to_utc("ts", "America/New_York").alias("at_utc"))


@query("safe_cast", """
    SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS whole_text,
           TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS first_digit,
           TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN '1995-13-01' ELSE '1995-12-01' END AS DATE)
             AS checked_date FROM orders""")
def safe_cast(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "F", "1995-13-01").otherwise("1995-12-01")
    return t.orders().select(
        "o_orderkey", F.col("o_orderpriority").try_cast("int").alias("whole_text"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("first_digit"),
        text.try_cast("date").alias("checked_date"),
    )


@query("row_transform", """
    SELECT c_custkey, upper(c_name) AS c_name, CAST(c_acctbal * 100 AS BIGINT) AS balance_cents
    FROM customer_v""")
def row_transform(t: Tables) -> DataFrame:
    shaped = conform.row_transform(t.customer(), {
        "c_name": F.upper("c_name"),
        "balance_cents": (F.col("c_acctbal") * 100).cast("long"),
    })
    return shaped.select("c_custkey", "c_name", "balance_cents")


@query("cast_int_flag", """
    SELECT impression_id, CAST(clicked AS INTEGER) AS clicked, CAST(converted AS INTEGER)
             AS converted, CAST(CAST(clicked AS INTEGER) AS BOOLEAN) AS back
    FROM ec_ad_impressions""")
def cast_int_flag(t: Tables) -> DataFrame:
    return t.ec_ad_impressions().select(
        "impression_id", F.col("clicked").cast("int").alias("clicked"),
        F.col("converted").cast("int").alias("converted"),
        F.col("clicked").cast("int").cast("boolean").alias("back"),
    )
