"""Ordered calculations that stay parallel inside a hot group.

A window sorts each group in one task. So the rows are cut into slots of about ``slot_rows``
rows along the keys and the ordering column: Spark's own range partitioning deals them, which
takes any orderable type and keeps equal positions together. What a slot needs from the other
slots of its group is computed from one small row per slot and enters it as an extra row,
which is dropped again afterwards. The number of slots follows from the number of rows; when
one slot is enough, a plain window gives the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.functions.scalars import hashable_columns
from tablehaul.session import saved

SLOT_ROWS = 2_000_000


def _same(df: DataFrame, other: DataFrame, columns: list[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & df[c].eqNullSafe(other[f"_k_{c}"])
    return condition


def _renamed(df: DataFrame, columns: list[str], *rest: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_k_{c}") for c in columns], *rest)


def slots_of(df: DataFrame, slot_rows: int) -> int:
    """How many slots a stored table needs."""
    return max(1, -(-df.count() // slot_rows))


def _with_slots(df: DataFrame, keys: list[str], order: str, slots: int) -> DataFrame:
    """Add ``_slot``, which grows with ``order`` inside each group, and store the result.

    ``df`` is a stored table: the range partitioning reads it twice.
    """
    dealt = df.repartitionByRange(slots, *keys, F.col(order).asc_nulls_first())
    return saved(dealt.withColumn("_slot", F.spark_partition_id()), "slots")


def running_total(
    df: DataFrame, keys: list[str], order: str, value: str, out: str, slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY keys ORDER BY order)``; equal ``order`` values share a total.

    NULL comes first in the order and NaN last, whatever the number of slots.
    """
    stored = saved(df, "ordered")
    total = F.sum(value)
    if (slots := slots_of(stored, slot_rows)) == 1:
        window = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_first())
        return stored.withColumn(out, total.over(window))
    kind = stored.agg(total.alias(out)).schema[out].dataType
    # Rows with the same position share a total, so the totals run over distinct positions.
    positions = saved(stored.groupBy(*keys, order).agg(total.alias("_sum")), "positions")
    sums = _with_slots(positions, keys, order, slots)
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sums.groupBy(*keys, "_slot").agg(F.sum("_sum").alias("_slot_sum"))
        .withColumn("_sum", F.sum("_slot_sum").over(earlier)).drop("_slot_sum")
        .filter(F.col("_sum").isNotNull()).withColumn("_extra", F.lit(True))
    )
    inside = Window.partitionBy(*keys, "_slot").orderBy(
        F.coalesce("_extra", F.lit(False)).desc(), F.col(order).asc_nulls_first()
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = saved(
        sums.unionByName(starts, allowMissingColumns=True)
        .withColumn(out, F.sum("_sum").over(inside).cast(kind)).filter(F.col("_extra").isNull()),
        "totals",
    )
    at = _renamed(totals, [*keys, order], out)
    return stored.join(at, _same(stored, at, [*keys, order])).select(*stored.columns, out)


def neighbour(
    df: DataFrame, keys: list[str], order: str, columns: list[str], step: str = "previous",
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Add ``<step>_<column>``: the value in the previous or next row of the same keys.

    NULL comes first in the order. Rows with the same position are put in order by a hash of the
    whole row, so the answer is the same every time and for any number of slots.
    """
    shift = F.lag if step == "previous" else F.lead

    def with_neighbours(part: DataFrame, by: list[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy("_place")
        return part.withColumns({f"{step}_{c}": shift(c).over(window) for c in columns})

    place = F.struct(F.col(order), F.xxhash64(*hashable_columns(df)))
    stored = saved(df.withColumn("_place", place), "ordered")
    if (slots := slots_of(stored, slot_rows)) == 1:
        return with_neighbours(stored, keys).drop("_place")
    cut = _with_slots(stored, keys, "_place", slots).withColumn("_extra", F.lit(False))
    # The last (or first) row of a slot is the extra row of the following (or preceding) one.
    edge = (F.max_by if step == "previous" else F.min_by)(
        F.struct("_place", *columns), F.col("_place")
    )
    edges = (
        cut.groupBy(*keys, "_slot").agg(edge.alias("_edge"))
        .withColumn("_edge", shift("_edge").over(Window.partitionBy(*keys).orderBy("_slot")))
        .filter(F.col("_edge").isNotNull())
        .select(*keys, "_slot", "_edge.*", F.lit(True).alias("_extra"))
    )
    placed = with_neighbours(cut.unionByName(edges, allowMissingColumns=True), [*keys, "_slot"])
    return placed.filter(~F.col("_extra")).drop("_slot", "_extra", "_place")


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, points: dict[str, float],
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Interpolated percentiles per group, from value counts instead of collected values.

    Equal values are counted before the shuffle, ranks come from running totals of the
    counts, and each percentile reads the one or two values at its position.
    """
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = saved(running_total(counted, keys, "_v", "_n", "_upto", slot_rows), "ranked")
    sizes = _renamed(ranked.groupBy(*keys).agg(F.sum("_n").alias("_total")), keys, "_total")
    placed = ranked.join(sizes, _same(ranked, sizes, keys))

    def at(index: Column) -> Column:
        inside = (index < F.col("_upto")) & (index >= F.col("_upto") - F.col("_n"))
        return F.max(F.when(inside, F.col("_v")))

    parts, result = [], []
    for name, p in points.items():
        position = (F.col("_total") - 1) * F.lit(p)
        parts += [
            at(F.floor(position)).alias(f"_lo_{name}"),
            at(F.ceil(position)).alias(f"_hi_{name}"),
            F.max(position - F.floor(position)).alias(f"_part_{name}"),
        ]
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        # Both ends equal covers infinities, whose difference is not a number.
        between = F.when(lo == hi, lo).otherwise(lo + (hi - lo) * F.col(f"_part_{name}"))
        result.append(between.alias(name))
    return (
        placed.groupBy(*keys).agg(F.max("_total").alias("n"), *parts).select(*keys, "n", *result)
    )
