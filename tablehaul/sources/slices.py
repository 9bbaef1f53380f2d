"""Slicing large tables by key range or month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.functions.scalars import yyyymm


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """Lowest key, highest key and row count, in one row."""
    return df.agg(
        F.min(key).alias("lowest"), F.max(key).alias("highest"), F.count(F.lit(1)).alias("rows")
    )


def _planned(df: DataFrame, lowest: int | None, highest: int | None, width: int) -> DataFrame:
    """The slices of a key range, made in many tasks."""
    n = 0 if lowest is None else (highest - lowest) // width + 1
    first = F.col("id") * width + F.lit(lowest or 0)
    return df.sparkSession.range(n).select(
        F.col("id").cast("int").alias("slice"), first.alias("first"),
        F.least(first + width - 1, F.lit(highest or 0).cast("long")).alias("last"),
    )


def plan_key_slices(df: DataFrame, key: str, width: int) -> DataFrame:
    """Inclusive key ranges of ``width`` ids that cover the whole table.

    The bounds are read first: one row.
    """
    bounds = key_bounds(df, key).first()
    return _planned(df, bounds["lowest"], bounds["highest"], width)


def slice_rows(df: DataFrame, key: str, width: int) -> DataFrame:
    """Rows per planned slice, empty slices included; the table is read twice."""
    bounds = key_bounds(df, key).first()
    slot = F.floor((F.col(key) - F.lit(bounds["lowest"])) / width).cast("int")
    counted = df.filter(F.col(key).isNotNull()).groupBy(slot.alias("slice")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    planned = _planned(df, bounds["lowest"], bounds["highest"], width)
    return planned.join(counted, "slice", "left").fillna({"rows": 0})


def month_slices(df: DataFrame, time: str) -> DataFrame:
    """Months present in the data as half-open date ranges, with their row counts."""
    months = df.groupBy(yyyymm(time).alias("month")).agg(F.count(F.lit(1)).alias("rows"))
    start = F.make_date(
        F.floor(F.col("month") / 100).cast("int"), F.col("month") % 100, F.lit(1)
    )
    return months.filter("month IS NOT NULL").select(
        "month", start.alias("from_date"), F.add_months(start, 1).alias("to_date"), "rows"
    )


def month_predicates(months: list[int], column: str) -> list[str]:
    """One predicate per month on the bare column, for a partitioned JDBC read."""
    predicates = []
    for month in sorted(months):
        year, number = divmod(month, 100)
        first = dt.date(year, number, 1)
        following = dt.date(year + number // 12, number % 12 + 1, 1)
        predicates.append(f"{column} >= DATE '{first}' AND {column} < DATE '{following}'")
    return predicates


def jdbc_range_options(
    url: str, table: str, key: str, lowest: int, highest: int, rows: int,
    slice_rows: int = 500_000, fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read in parallel key ranges of about ``slice_rows`` rows each."""
    return {
        "url": url, "dbtable": table, "partitionColumn": key,
        "lowerBound": str(lowest), "upperBound": str(highest + 1),
        "numPartitions": str(max(1, -(-rows // slice_rows))), "fetchsize": str(fetch_rows),
    }


def read_jdbc_range(
    spark: SparkSession, url: str, table: str, key: str, slice_rows: int = 500_000,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a database table in parallel key ranges: bounds first, then one query per range."""
    reader = spark.read.format("jdbc").options(url=url, **(properties or {}))
    bounds = reader.option(
        "query", f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT(*) AS n FROM {table}"
    ).load().first()
    lowest, highest, rows = bounds
    if not rows or lowest is None:
        return spark.read.format("jdbc").options(
            url=url, dbtable=table, **(properties or {})
        ).load()
    options = jdbc_range_options(url, table, key, int(lowest), int(highest), int(rows), slice_rows)
    return spark.read.format("jdbc").options(**options, **(properties or {})).load()


def read_jdbc_months(
    spark: SparkSession, url: str, table: str, column: str, months: list[int],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a database table with one parallel query per month."""
    return spark.read.jdbc(
        url, table, predicates=month_predicates(months, column), properties=properties or {}
    )
