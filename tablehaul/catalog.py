"""Views over the given Parquet tables, as DataFrames.

``catalog_sql`` holds the same views as SQL text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablehaul.functions.scalars import money, pick
from tablehaul.operators import augment
from tablehaul.session import fit_shuffles, stored_bytes

AS_OF_ORDERS = dt.datetime(2001, 8, 2)
AS_OF_EVENTS = dt.datetime(2024, 1, 31)

SHIP_MODES = ["AIR", "FOB", "MAIL", "RAIL", "REG AIR", "SHIP", "TRUCK"]
USER_COUNTRIES = ["US", "GB", "DE", "JP", "SG"]
REFERRERS = ["search.example", "", "social.example", "news.example"]
DEVICES = ["desktop", "mobile", "tablet"]
BROWSERS = ["chrome", "safari", "firefox", "edge"]
UTM_SOURCES = ["newsletter", "", "ads", "partner", ""]
UTM_MEDIUMS = ["email", "", "cpc"]
UTM_CAMPAIGNS = ["spring", "", "launch", "retarget"]
WAREHOUSES = ["WH-EAST", "WH-WEST", "WH-NORTH", "WH-SOUTH", "WH-CENTRAL"]
SNAPSHOT_DAYS = 7
STRATEGIES = ["direct", "s3_stage", "gcs_stage"]
PHASES = ["unloading", "staged", "loading", "validating"]


def ts_lit(value: dt.datetime | dt.date | str):
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value: dt.date | str):
    return F.lit(str(value)[:10]).cast("date")


class Tables:
    """Named tables and derived views for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._schemas: dict[str, StructType] = {}
        self._bytes = 0

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def raw(self, name: str) -> DataFrame:
        """A table as stored; its schema is read from the files only once.

        Every table that a query reads adds to the size its shuffles are fitted to.
        """
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(self.path(name)).schema
            self._bytes += stored_bytes(self.spark, self.path(name))
            fit_shuffles(self.spark, self._bytes)
        return self.spark.read.schema(self._schemas[name]).parquet(self.path(name))

    # ---- warehouse -----------------------------------------------------
    def region(self) -> DataFrame:
        return self.raw("region")

    def nation(self) -> DataFrame:
        return self.raw("nation")

    def customer(self) -> DataFrame:
        return self.raw("customer").withColumn("c_acctbal", money("c_acctbal"))

    def part(self) -> DataFrame:
        return self.raw("part").withColumn("p_retailprice", money("p_retailprice", 10))

    def orders(self) -> DataFrame:
        return self.raw("orders").withColumns(
            {"o_totalprice": money("o_totalprice"), "o_orderdate": F.to_date("o_orderdate")}
        )

    def lineitem(self) -> DataFrame:
        return self.raw("lineitem").withColumns({
            "l_quantity": F.col("l_quantity").cast("int"),
            "l_extendedprice": money("l_extendedprice"),
            "l_discount": money("l_discount"),
            "l_tax": money("l_tax"),
            "l_shipdate": F.to_date("l_shipdate"),
        })

    def orders_aug(self, form: str = "struct") -> DataFrame:
        build = getattr(augment, f"order_metadata_{form}")
        return self.orders().withColumn("order_metadata", build(F.col("o_orderkey")))

    def lineitem_aug(self) -> DataFrame:
        return self.lineitem().withColumns({
            "l_shipmode": pick(SHIP_MODES, F.col("l_linenumber") - 1),
            "delivery_at": augment.delivery_at("l_shipdate"),
        })

    def customer_aug(self) -> DataFrame:
        return self.customer().withColumn(
            "contact_addresses", augment.contact_addresses(F.col("c_custkey"))
        )

    # ---- e-commerce ----------------------------------------------------
    def ec_users(self) -> DataFrame:
        firsts = self.orders().groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.min("o_orderdate").alias("first_order"),
            F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("delivered"),
        )
        return self.customer().join(firsts, "c_custkey", "left").select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_mktsegment").alias("segment"),
            pick(USER_COUNTRIES, F.pmod("c_nationkey", F.lit(5))).alias("country_code"),
            F.coalesce("first_order", date_lit("1995-01-01")).alias("registration_date"),
            F.coalesce("delivered", F.lit(0)).cast("decimal(38,2)").alias("lifetime_value"),
        )

    def ec_countries(self) -> DataFrame:
        """Only what a lookup by user needs: no order scan behind it."""
        return self.customer().select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_mktsegment").alias("segment"),
            pick(USER_COUNTRIES, F.pmod("c_nationkey", F.lit(5))).alias("country_code"),
        )

    def ec_products(self) -> DataFrame:
        return self.part().select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            F.col("p_retailprice").alias("price"),
        )

    def ec_orders(self) -> DataFrame:
        """Orders with a time of day; ``order_day`` is the day of ``created_at``."""
        return self.orders().select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "O", "shipped")
            .otherwise("cancelled").alias("status"),
            F.col("o_totalprice").alias("total_amount"),
            F.col("o_orderdate").alias("order_day"),
            F.timestamp_add(
                "SECOND",
                F.pmod("o_orderkey", F.lit(86400)).cast("int"),
                F.col("o_orderdate").cast("timestamp_ntz"),
            ).alias("created_at"),
        )

    def ec_order_items(self) -> DataFrame:
        return self.lineitem().select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("unit_price"),
            (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_pct"),
        )

    def events(self) -> DataFrame:
        """Events with the number inside ``props`` pulled out and exact values."""
        return self.raw("events").withColumns({
            "value": money("value"),
            "k": F.get_json_object("props", "$.k").cast("int"),
        })

    def ec_events(self) -> DataFrame:
        return self.events().select(
            "event_id", "user_id", "k",
            F.when(F.col("event_type") == "view", "page_view")
            .when(F.col("event_type") == "click", "add_to_cart")
            .otherwise(F.col("event_type")).alias("event_type"),
            F.col("ts").alias("created_at"),
            F.to_json(F.struct(
                F.concat(F.lit("item_"), F.col("k")).alias("label"),
                F.col("value"),
            )).alias("properties"),
        )

    def ec_ad_impressions(self) -> DataFrame:
        return self.events().select(
            F.col("event_id").alias("impression_id"),
            F.pmod("user_id", F.lit(20)).alias("campaign_id"),
            F.col("event_type").alias("placement"),
            (F.col("k") < 5).alias("clicked"),
            (F.col("k") < 2).alias("converted"),
            (F.col("k") * 90 + 1000).cast("long").alias("cost_micros"),
            F.col("ts").alias("impression_at"),
        )

    # ---- sessions: one per user and day ---------------------------------
    def _sessions(self) -> DataFrame:
        at = F.struct("ts", "event_id")
        e = self.events().withColumn("day", F.to_date("ts"))
        return e.groupBy("user_id", "day").agg(
            F.min("ts").alias("started_at"),
            F.max("ts").alias("ended_at"),
            F.count(F.lit(1)).alias("page_count"),
            F.min_by("event_type", at).alias("first_type"),
            F.max_by("event_type", at).alias("last_type"),
        ).withColumns({
            "session_id": _session_id(),
            "duration_seconds": F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at")),
        })

    def ec_sessions(self) -> DataFrame:
        return self._sessions().select(
            "session_id", "user_id", "started_at", "ended_at", "page_count",
            F.when(F.col("page_count") > 1, F.col("duration_seconds")).alias("duration_seconds"),
            _by_user(REFERRERS).alias("referrer_source"),
        )

    def web_sessions(self) -> DataFrame:
        return self._sessions().select(
            "session_id",
            F.lit(1).alias("project_id"),
            F.concat(F.lit("v"), F.col("user_id")).alias("visitor_id"),
            "started_at", "day", "duration_seconds",
            F.col("page_count").alias("pageview_count"),
            (F.col("page_count") == 1).cast("int").alias("is_bounce"),
            F.concat(F.lit("/"), F.col("first_type")).alias("entry_page"),
            F.concat(F.lit("/"), F.col("last_type")).alias("exit_page"),
            _by_user(REFERRERS).alias("referrer_domain"),
            _by_user(UTM_SOURCES).alias("utm_source"),
            _by_user(UTM_MEDIUMS).alias("utm_medium"),
            _by_user(UTM_CAMPAIGNS).alias("utm_campaign"),
            _by_user(DEVICES).alias("device_type"),
            _by_user(BROWSERS).alias("browser"),
            _by_user(USER_COUNTRIES).alias("country_code"),
        )

    def web_pageviews(self) -> DataFrame:
        variant = F.concat(F.lit("v"), F.pmod("event_id", F.lit(3)))
        logged_in = F.when(F.pmod("event_id", F.lit(2)) == 0, "true").otherwise("false")
        return self.events().select(
            F.col("ts").alias("timestamp"),
            F.lit(1).alias("project_id"),
            F.concat(F.lit("v"), F.col("user_id")).alias("visitor_id"),
            F.concat(F.lit("/"), F.col("event_type")).alias("url"),
            (F.floor("value") + 5).cast("int").alias("duration_seconds"),
            F.col("k").alias("scroll_depth"),
            F.when(
                F.pmod("event_id", F.lit(10)) == 9,
                F.create_map(F.lit("logged_in"), logged_in),
            ).otherwise(
                F.create_map(F.lit("ab_variant"), variant, F.lit("logged_in"), logged_in)
            ).alias("properties"),
        )

    def web_conversions(self) -> DataFrame:
        e = self.events().filter(F.col("event_type").isin("purchase", "signup"))
        paid = (F.col("event_type") == "purchase") & (F.pmod("event_id", F.lit(3)) == 0)
        return e.withColumn("day", F.to_date("ts")).select(
            F.col("ts").alias("timestamp"),
            F.lit(1).alias("project_id"),
            F.concat(F.lit("v"), F.col("user_id")).alias("visitor_id"),
            _session_id().alias("session_id"),
            F.col("event_type").alias("goal_name"),
            F.when(paid, F.col("value")).otherwise(F.lit(0)).cast("decimal(10,2)").alias("revenue"),
        )

    # ---- change stream, damaged copies, ledger ----------------------------
    def cdc_base(self) -> DataFrame:
        """Target table before the changes: one market segment has not arrived yet."""
        return self.customer().filter("c_mktsegment <> 'FURNITURE'").select(
            F.col("c_custkey").alias("key"), "c_acctbal", F.lit(-1).cast("long").alias("version")
        )

    def changes(self) -> DataFrame:
        return self.orders().select(
            F.col("o_custkey").alias("key"),
            F.col("o_totalprice").alias("c_acctbal"),
            F.col("o_orderkey").alias("version"),
            F.when(F.col("o_orderstatus") == "P", "D").otherwise("U").alias("op"),
        )

    def copied(self, name: str) -> DataFrame:
        """A copy with known damage for the checks to find.

        orders: the last days are missing; lineitem: returned lines cost 0.50 more;
        customer: segments of one nation are NULL.
        """
        if name == "orders":
            return self.orders().filter(F.col("o_orderdate") < date_lit("2001-07-25"))
        if name == "lineitem":
            price = F.col("l_extendedprice")
            return self.lineitem().withColumn(
                "l_extendedprice",
                F.when(F.col("l_returnflag") == "R", price + money(F.lit("0.50")))
                .otherwise(price).cast("decimal(12,2)"),
            )
        if name == "customer":
            return self.customer().withColumn(
                "c_mktsegment", F.when(F.col("c_nationkey") != 7, F.col("c_mktsegment"))
            )
        return getattr(self, name)() if hasattr(self, name) else self.raw(name)

    def ledger_events(self) -> DataFrame:
        """Ten runs; the last one is in the middle of a staged load, whose strategy only the
        registration of its tables names."""
        e = self.events()
        mid_load = F.pmod("user_id", F.lit(10)) == 9
        kind = pick(["batch_done", "bytes_progress", "table_done", "phase_started", "log"], (
            F.array_position(
                F.array(*map(F.lit, ("view", "click", "purchase", "signup"))), e.event_type
            ) + 4
        ) % 5)
        kind = (
            F.when(mid_load & kind.isin("batch_done", "table_done"), "bytes_progress")
            .when(mid_load & (kind == "log"), "table_registered").otherwise(kind)
        )
        strategy = F.when(
            ~mid_load, pick(STRATEGIES, F.pmod("user_id", F.lit(3)))
        ).when(kind == "table_registered", STRATEGIES[1])
        return e.select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("run-"), F.pmod("user_id", F.lit(10))).alias("run_id"),
            "ts", kind.alias("kind"),
            F.to_json(F.struct(
                F.concat(F.lit("t"), F.pmod("user_id", F.lit(3))).alias("table"),
                (F.col("k") * 1000).cast("long").alias("rows"),
                (F.col("value") / 10).cast("decimal(12,3)").alias("seconds"),
                (F.col("event_id") * 1000000).alias("bytes_done"),
                (F.col("event_id") * 1000000 + 500000000).alias("total_bytes"),
                strategy.alias("strategy"),
                pick(PHASES, F.pmod("k", F.lit(4))).alias("phase"),
            )).alias("payload_json"),
        )

    def bench_rows(self) -> DataFrame:
        e = self.events()
        source_ms = (e.value * 10).cast("decimal(14,2)").cast("double")
        target_ms = e.k.cast("double")
        failed = e.event_type == "error"
        return e.select(
            F.concat(F.lit("run-"), F.pmod("user_id", F.lit(10))).alias("run_id"),
            F.col("event_id").alias("query_n"),
            source_ms.alias("source_ms"),
            F.when(~failed, target_ms).alias("target_ms"),
            (source_ms + e.k * 3).alias("source_wall_ms"),
            F.when(~failed, target_ms + 60).alias("target_wall_ms"),
            (e.k * 10).cast("long").alias("source_rows"),
            F.when(~failed, F.when(e.event_type == "click", e.k * 10 + 1).otherwise(e.k * 10))
            .cast("long").alias("target_rows"),
            F.lit(None).cast("string").alias("source_error"),
            F.when(failed, "timeout").alias("target_error"),
        )


def _by_user(values: list[str]):
    return pick(values, F.pmod("user_id", F.lit(len(values))))


def _session_id():
    return F.concat(F.col("user_id"), F.lit("-"), F.date_format("day", "yyyyMMdd"))
