"""Workload preparation: derived columns and tables added before a migration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul import fixed_values as fv
from tablehaul.functions.scalars import pick, zone_to_utc


def order_metadata_fields(key: Column) -> dict[str, Column]:
    def by_modulo(values):
        return pick(values, F.pmod(key, F.lit(len(values))))

    return {
        "payment_method": by_modulo(fv.PAYMENT_METHODS),
        "customer_segment": by_modulo(fv.CUSTOMER_SEGMENTS),
        "order_source": by_modulo(fv.ORDER_SOURCES),
        "shipping_expedited": F.pmod(key, F.lit(fv.EXPEDITED_EVERY)) == 0,
    }


def order_metadata_struct(key: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in order_metadata_fields(key).items()])


def order_metadata_map(key: Column) -> Column:
    """String map; the flag is stored as '1' or '0'."""
    pairs = []
    for name, c in order_metadata_fields(key).items():
        text = F.when(c, "1").otherwise("0") if name == "shipping_expedited" else c
        pairs += [F.lit(name), text]
    return F.create_map(*pairs)


def order_metadata_json(key: Column) -> Column:
    return F.to_json(order_metadata_struct(key))


def order_metadata_variant(key: Column) -> Column:
    return F.to_variant_object(order_metadata_struct(key))


def delivery_at(ship_date: Column | str) -> Column:
    """Midnight of the ship date in the delivery zone, as a UTC instant."""
    return zone_to_utc(ship_date, fv.DELIVERY_ZONE)


def contact_addresses(key: Column) -> Column:
    """One to three address structs, driven by the customer key."""
    key = key.cast("long")

    def address(offset):
        n = key + offset
        slot = F.pmod(n, F.lit(len(fv.CITIES)))
        return F.struct(
            F.concat(n.cast("string"), F.lit(fv.STREET_SUFFIX)).alias("line"),
            pick(fv.CITIES, slot).alias("city"),
            pick(fv.COUNTRIES, slot).alias("country"),
        )

    return F.transform(F.sequence(F.lit(0).cast("long"), F.pmod(key, F.lit(3))), address)


def refresh_total(base: DataFrame, totals: DataFrame, key: str, column: str) -> DataFrame:
    """UPDATE ... FROM an aggregate: rows without a new total keep the old value.

    ``totals`` has one row per key, so the join cannot multiply rows.
    """
    fresh = totals.select(F.col(key), F.col(column).alias("_fresh"))
    return (
        base.join(fresh, key, "left")
        .withColumn(column, F.coalesce("_fresh", column))
        .drop("_fresh")
    )


def hash_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """The ``size`` rows with the lowest key hash: the same rows on every run.

    Every partition keeps its own lowest rows, so one pass is enough and nothing is stored.
    """
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(size)


#: Cells of a grid that one number marks.
_WORD = 62


def missing_grid(keys: DataFrame, axes: dict[str, Column], existing: DataFrame) -> DataFrame:
    """Every key combined with literal axes, less the combinations already present.

    The axes are short literal arrays, so they are exploded per row rather than joined. What is
    present becomes marks in a few numbers per key: keys are joined instead of combinations, by
    sorting, since the size of exploded rows is unknown to Spark and no task may hold all of them.
    """
    at = F.lit(0).cast("long")
    known = F.lit(True)
    for name, values in axes.items():
        place = F.array_position(values, F.col(name))  # NULL or 0: no such place
        at, known = at * F.size(values) + place - 1, known & (place > 0)
    word, mark = F.floor(at / _WORD), F.call_function("shiftleft", F.lit(1).cast("long"), (at % _WORD).cast("int"))
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = (
        existing.repartition(parts, *keys.columns).filter(known)
        .groupBy(*keys.columns, word.alias("_word")).agg(F.bit_or(mark).alias("_marks"))
        .groupBy(*keys.columns).agg(F.map_from_entries(F.collect_list(F.struct("_word", "_marks"))).alias("_taken"))
    )
    grid = keys.repartition(parts, *keys.columns).join(taken.hint("merge"), keys.columns, "left")
    for name, values in axes.items():
        grid = grid.withColumn(name, F.explode(values))
    present = F.try_element_at("_taken", word).bitwiseAND(mark) != 0
    return grid.filter(~F.coalesce(present, F.lit(False))).select(*keys.columns, *axes)
