"""Scalar functions, each run over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.catalog import SHIP_MODES, Tables, date_lit
from tablehaul.functions.scalars import (
    clean_identifier, hour_boundaries, hours_whole, map_text, month_boundaries,
    months_wrapping, pick, trunc_to, yyyymm,
)
from tablehaul.registry import query


@query("fn_date_trunc", """
    SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS hour,
           CAST(date_trunc('month', ts) AS DATE) AS month FROM events_v""")
def fn_date_trunc(t: Tables) -> DataFrame:
    return t.events().select(
        "event_id", F.to_date("ts").alias("day"), trunc_to("hour", "ts").alias("hour"),
        F.trunc("ts", "month").alias("month"),
    )


@query("fn_yyyymm", """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month FROM orders_v""")
def fn_yyyymm(t: Tables) -> DataFrame:
    return t.orders().select("o_orderkey", yyyymm("o_orderdate").alias("month"))


@query("fn_extract", """
    SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m,
           CAST(hour(ts) AS INTEGER) AS h, epoch_us(ts) AS epoch_micros FROM events_v""")
def fn_extract(t: Tables) -> DataFrame:
    return t.events().select(
        "event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.hour("ts").alias("h"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("epoch_micros"),
    )


@query("fn_month_diff", """
    SELECT o_orderkey,
           CAST(datediff('month', DATE '1995-01-15', o_orderdate) AS BIGINT) AS boundaries,
           CAST(extract(month FROM age(o_orderdate, DATE '1995-01-01')) AS BIGINT) AS wrapping
    FROM orders_v""")
def fn_month_diff(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders().select(
        "o_orderkey", month_boundaries(day, date_lit("1995-01-15")).alias("boundaries"),
        months_wrapping(day, date_lit("1995-01-01")).alias("wrapping"),
    )


@query("fn_hour_diff", """
    SELECT event_id, datesub('hour', TIMESTAMP '2024-01-01 00:30:00', ts) AS whole_hours,
           datediff('hour', TIMESTAMP '2024-01-01 00:30:00', ts) AS boundaries FROM events_v""")
def fn_hour_diff(t: Tables) -> DataFrame:
    start = F.lit("2024-01-01 00:30:00").cast("timestamp_ntz")
    return t.events().select(
        "event_id", hours_whole(F.col("ts"), start).alias("whole_hours"),
        hour_boundaries(F.col("ts"), start).alias("boundaries"),
    )


@query("fn_date_add", """
    SELECT o_orderkey, o_orderdate + 30 AS due, CAST(o_orderdate + INTERVAL 1 MONTH AS DATE)
             AS next_month FROM orders_v""")
def fn_date_add(t: Tables) -> DataFrame:
    return t.orders().select(
        "o_orderkey", F.date_add("o_orderdate", 30).alias("due"),
        F.add_months("o_orderdate", 1).alias("next_month"),
    )


@query("fn_timezone", """
    SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS new_york,
           (ts AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS utc_of_local
    FROM events_v""")
def fn_timezone(t: Tables) -> DataFrame:
    utc, zone = F.lit("UTC"), F.lit("America/New_York")
    return t.events().select(
        "event_id", F.convert_timezone(utc, zone, "ts").alias("new_york"),
        F.convert_timezone(zone, utc, "ts").alias("utc_of_local"),
    )


@query("fn_date_format", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month_text,
           strftime(o_orderdate, '%d/%m/%Y') AS day_text FROM orders_v""")
def fn_date_format(t: Tables) -> DataFrame:
    return t.orders().select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month_text"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("day_text"),
    )


@query("fn_null_handling", """
    SELECT session_id, CAST(coalesce(duration_seconds, 0) AS BIGINT) AS seconds,
           nullif(referrer_source, '') AS referrer,
           ifnull(nullif(referrer_source, ''), '(direct)') AS label FROM ec_sessions""")
def fn_null_handling(t: Tables) -> DataFrame:
    referrer = F.nullif("referrer_source", F.lit(""))
    return t.ec_sessions().select(
        "session_id", F.coalesce("duration_seconds", F.lit(0)).alias("seconds"),
        referrer.alias("referrer"), F.ifnull(referrer, F.lit("(direct)")).alias("label"),
    )


@query("fn_conditional", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium'
                ELSE 'large' END AS size_band,
           if(l_returnflag = 'R', 1, 0) AS returned FROM lineitem_v""")
def fn_conditional(t: Tables) -> DataFrame:
    quantity = F.col("l_quantity")
    return t.lineitem().select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(quantity < 10, "small").when(quantity < 30, "medium").otherwise("large")
        .alias("size_band"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"),
    )


@query("fn_round_half_even", """
    SELECT event_id, round_even(k / 2::DOUBLE, 0) AS whole, round_even(k / 4::DOUBLE, 1) AS tenth
    FROM events_v""")
def fn_round_half_even(t: Tables) -> DataFrame:
    return t.events().select(
        "event_id", F.bround(F.col("k") / 2, 0).alias("whole"),
        F.bround(F.col("k") / 4, 1).alias("tenth"),
    )


@query("fn_round_half_up", """
    SELECT event_id, round(k / 2::DOUBLE, 0) AS whole, round(k / 4::DOUBLE, 1) AS tenth
    FROM events_v""")
def fn_round_half_up(t: Tables) -> DataFrame:
    return t.events().select(
        "event_id", F.round(F.col("k") / 2, 0).alias("whole"),
        F.round(F.col("k") / 4, 1).alias("tenth"),
    )


@query("fn_div_float", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           l_quantity::DOUBLE / (l_linenumber + 1) AS quotient FROM lineitem_v""")
def fn_div_float(t: Tables) -> DataFrame:
    return t.lineitem().select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_quantity") / (F.col("l_linenumber") + 1)).alias("quotient"),
    )


@query("fn_div_null", """
    SELECT event_id, 100::DOUBLE / nullif(k, 0) AS quotient FROM events_v""")
def fn_div_null(t: Tables) -> DataFrame:
    return t.events().select("event_id", F.try_divide(F.lit(100), "k").alias("quotient"))


@query("fn_modulo", """
    SELECT o_orderkey, o_orderkey % 4 AS by_four, ((o_orderkey - 7) % 5 + 5) % 5 AS shifted
    FROM orders""")
def fn_modulo(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders().select(
        "o_orderkey", F.pmod(key, F.lit(4)).alias("by_four"),
        F.pmod(key - 7, F.lit(5)).alias("shifted"),
    )


@query("fn_concat", """
    SELECT c_custkey, c_mktsegment || '/' || CAST(c_nationkey AS VARCHAR) AS label FROM customer""")
def fn_concat(t: Tables) -> DataFrame:
    return t.customer().select(
        "c_custkey", F.concat("c_mktsegment", F.lit("/"), F.col("c_nationkey")).alias("label")
    )


@query("fn_lpad", """
    SELECT p_partkey, 'SKU-' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS sku FROM part""")
def fn_lpad(t: Tables) -> DataFrame:
    digits = F.col("p_partkey").cast("string")
    return t.part().select(
        "p_partkey", F.concat(F.lit("SKU-"), F.lpad(digits, 8, "0")).alias("sku")
    )


@query("fn_json_text", """
    SELECT o_orderkey, payment_method, order_source FROM orders_aug""")
def fn_json_text(t: Tables) -> DataFrame:
    def text(name):
        return F.get_json_object("order_metadata", f"$.{name}").alias(name)

    return t.orders_aug("json").select("o_orderkey", text("payment_method"), text("order_source"))


@query("fn_json_number", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events""")
def fn_json_number(t: Tables) -> DataFrame:
    return t.raw("events").select(
        "event_id", F.variant_get(F.parse_json("props"), "$.k", "double").alias("k")
    )


@query("fn_json_raw", """
    SELECT o_orderkey, CASE WHEN shipping_expedited THEN 'true' ELSE 'false' END AS expedited_raw
    FROM orders_aug""")
def fn_json_raw(t: Tables) -> DataFrame:
    return t.orders_aug("json").select(
        "o_orderkey",
        F.get_json_object("order_metadata", "$.shipping_expedited").alias("expedited_raw"),
    )


@query("fn_json_array", """
    SELECT c_custkey, max(CASE WHEN addr_offset = 0 THEN city END) AS first_city,
           CAST(count(*) AS INTEGER) AS n_addresses FROM addresses GROUP BY c_custkey""")
def fn_json_array(t: Tables) -> DataFrame:
    text = F.to_json("contact_addresses")
    parsed = F.from_json(text, "array<struct<line:string,city:string,country:string>>")
    return t.customer_aug().withColumn("parsed", parsed).select(
        "c_custkey", F.col("parsed")[0]["city"].alias("first_city"),
        F.size("parsed").alias("n_addresses"),
    )


@query("fn_json_build", """
    SELECT o_orderkey, CAST(json_object('payment_method', payment_method, 'customer_segment',
             customer_segment, 'order_source', order_source, 'shipping_expedited',
             shipping_expedited) AS VARCHAR) AS metadata FROM orders_aug""")
def fn_json_build(t: Tables) -> DataFrame:
    return t.orders_aug("json").select("o_orderkey", F.col("order_metadata").alias("metadata"))


@query("fn_map_get", """
    SELECT "timestamp", ab_variant, logged_in, '' AS absent FROM web_pageviews""")
def fn_map_get(t: Tables) -> DataFrame:
    return t.web_pageviews().select(
        "timestamp", *[map_text("properties", k).alias(k) for k in ("ab_variant", "logged_in", "absent")]
    )


@query("fn_map_contains", """
    SELECT "timestamp", ab_variant <> '' AS has_variant FROM web_pageviews""")
def fn_map_contains(t: Tables) -> DataFrame:
    return t.web_pageviews().select(
        "timestamp", F.map_contains_key("properties", "ab_variant").alias("has_variant")
    )


@query("fn_struct_get", """
    SELECT o_orderkey, customer_segment, shipping_expedited FROM orders_aug""")
def fn_struct_get(t: Tables) -> DataFrame:
    return t.orders_aug("struct").select(
        "o_orderkey", "order_metadata.customer_segment", "order_metadata.shipping_expedited"
    )


@query("fn_array_get", """
    SELECT c_custkey, max(CASE WHEN addr_offset = 0 THEN country END) AS first_country,
           max(CASE WHEN addr_offset = 2 THEN country END) AS third_country
    FROM addresses GROUP BY c_custkey""")
def fn_array_get(t: Tables) -> DataFrame:
    """Index 0 and index 1 of the two conventions are the same element; past the end is NULL."""
    countries = F.col("contact_addresses.country")
    return t.customer_aug().select(
        "c_custkey", F.element_at(countries, 1).alias("first_country"),
        F.get(countries, 2).alias("third_country"),
    )


@query("fn_array_map", """
    SELECT c_custkey, string_agg(upper(city), ';' ORDER BY addr_offset) AS cities
    FROM addresses GROUP BY c_custkey""")
def fn_array_map(t: Tables) -> DataFrame:
    upper = F.transform("contact_addresses", lambda a: F.upper(a["city"]))
    return t.customer_aug().select("c_custkey", F.array_join(upper, ";").alias("cities"))


@query("fn_array_range", """
    SELECT o_orderkey, unnest(range(0, o_orderkey % 4 + 1)) AS n FROM orders""")
def fn_array_range(t: Tables) -> DataFrame:
    upto = F.pmod("o_orderkey", F.lit(4))
    return t.orders().select(
        "o_orderkey", F.explode(F.sequence(F.lit(0).cast("long"), upto)).alias("n")
    )


@query("fn_array_pick", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipmode FROM lineitem_aug""")
def fn_array_pick(t: Tables) -> DataFrame:
    return t.lineitem().select(
        "l_orderkey", "l_linenumber", "l_partkey",
        pick(SHIP_MODES, F.col("l_linenumber") - 1).alias("l_shipmode"),
    )


@query("fn_casts", """
    SELECT event_id, CAST(k < 50 AS INTEGER) AS flag, CAST(value AS DOUBLE) AS as_double,
           CAST(CAST(value * 3 AS DECIMAL(14,2)) AS VARCHAR) AS as_text,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS from_text FROM events_v""")
def fn_casts(t: Tables) -> DataFrame:
    return t.events().select(
        "event_id", (F.col("k") < 50).cast("int").alias("flag"),
        F.col("value").cast("double").alias("as_double"),
        (F.col("value") * 3).cast("decimal(14,2)").cast("string").alias("as_text"),
        F.get_json_object("props", "$.k").cast("long").alias("from_text"),
    )


@query("fn_identifier_sanitize", """
    SELECT c_custkey, regexp_replace(c_name, '[^0-9A-Za-z_]', '_', 'g') AS identifier
    FROM customer""")
def fn_identifier_sanitize(t: Tables) -> DataFrame:
    return t.customer().select("c_custkey", clean_identifier("c_name").alias("identifier"))
