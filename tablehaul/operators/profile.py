"""Discovery and profiling of source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul import fixed_values as fv
from tablehaul.functions.scalars import yyyymm


def column_profile(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Rows, non-null rows, distinct values, minimum and maximum, one row per column.

    All facts and estimates of the distinct values come from one aggregate over one scan. With
    ``exact`` each column's values are also counted on their own: that scan reads just the
    column, and equal values meet before the shuffle.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def facts(c: str) -> Column:
        value = F.col(c)
        return F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
            F.count(F.lit(1)).alias("rows"), F.count(value).alias("non_null"),
            (F.lit(0).cast("long") if exact else F.approx_count_distinct(value)).alias("distinct_values"),
            F.min(value).cast("string").alias("min_value"),
            F.max(value).cast("string").alias("max_value"),
        )

    together = df.agg(F.array(*[facts(c) for c in columns]).alias("facts"))
    profile = together.select(F.explode("facts").alias("f")).select("f.*")
    if not exact:
        return profile
    counts = reduce(DataFrame.unionByName, [
        df.filter(F.col(c).isNotNull()).select(c).distinct()
        .agg(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("distinct_values"))
        for c in columns
    ])
    return profile.drop("distinct_values").join(counts, "column_name").select(profile.columns)


def suggest_types(profile: DataFrame) -> DataFrame:
    """Target type per profiled column: narrowest integer, decimal scale, low cardinality."""
    low, high = (F.col(c).try_cast("decimal(38,0)") for c in ("min_value", "max_value"))

    def between(lowest, highest):
        return (low >= F.lit(lowest).cast("decimal(38,0)")) & (
            high <= F.lit(highest).cast("decimal(38,0)")
        )

    integer = (
        F.when(between(0, 2**8 - 1), "UInt8").when(between(0, 2**16 - 1), "UInt16")
        .when(between(0, 2**32 - 1), "UInt32")
        .when(between(-(2**7), 2**7 - 1), "Int8").when(between(-(2**15), 2**15 - 1), "Int16")
        .when(between(-(2**31), 2**31 - 1), "Int32").otherwise("Int64")
    )
    kind = F.col("data_type")
    target = (
        F.when(kind.isin("tinyint", "smallint", "int", "bigint"), integer)
        .when(kind.startswith("decimal"), F.concat(F.lit("D"), F.substring(kind, 2, 30)))
        .when(
            (kind == "string") & (F.col("distinct_values") < fv.LOW_CARDINALITY_LIMIT),
            "LowCardinality(String)",
        )
        .when(kind == "string", "String").when(kind == "date", "Date")
        .when(kind == "timestamp_ntz", "DateTime").when(kind == "timestamp", "DateTime64(3, 'UTC')")
        .when(kind == "boolean", "Bool").when(kind.isin("float", "double"), "Float64")
        .otherwise("JSON")
    )
    return profile.select(
        "column_name", target.alias("target_type"),
        (F.col("non_null") < F.col("rows")).alias("nullable"),
    )


def enum_drift(df: DataFrame, column: str, declared: list[str]) -> DataFrame:
    """Values in the data that the declared set lacks, with their row counts."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(declared))
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    )


def sample_rows(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*order).limit(n)


def array_homogeneity(df: DataFrame, json_array: Column) -> DataFrame:
    """How many elements of JSON arrays have which type; one row means a typed array fits."""
    elements = df.select(F.explode(F.from_json(json_array, "array<variant>")).alias("element"))
    kind = F.regexp_replace(F.schema_of_variant("element"), r"\(.*", "")
    return elements.groupBy(kind.alias("element_type")).agg(F.count(F.lit(1)).alias("elements"))


def fk_inclusion(pairs: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Share of distinct child keys found in the parent, one row per candidate pair.

    Both sides are reduced to distinct keys before they meet, so a hot key is one row.
    """
    def one(name, child, child_key, parent, parent_key):
        children = child.groupBy(F.col(child_key).alias("k")).agg(
            F.count(F.lit(1)).alias("child_rows")
        ).filter("k IS NOT NULL")
        parents = parent.select(F.col(parent_key).alias("k")).distinct().withColumn(
            "found", F.lit(True)
        )
        return children.join(parents, "k", "left").agg(
            F.lit(name).alias("pair"), F.count(F.lit(1)).alias("child_keys"),
            F.count("found").alias("matched_keys"), F.sum("child_rows").alias("child_rows"),
        )

    checks = [one(name, *pair) for name, pair in pairs.items()]
    share = F.try_divide(F.col("matched_keys"), F.col("child_keys"))
    return reduce(DataFrame.unionByName, checks).withColumns({
        "share": F.round(share, 6), "is_foreign_key": share == 1,
    })


def partition_sizes(df: DataFrame, time: str, fewest: int = 10, most: int = 100) -> DataFrame:
    """Rows per month, with a verdict on the number of months."""
    months = df.groupBy(yyyymm(time).alias("month")).agg(F.count(F.lit(1)).alias("rows"))
    # The window runs over one row per distinct month, a few hundred at most.
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    verdict = F.when(n > most, "too many").when(n < fewest, "few").otherwise("ok")
    return months.withColumn("partition_count", verdict)


def sort_key_hint(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Candidate sort-key order: the given filter columns from low to high cardinality."""
    profile = column_profile(df, columns, exact)
    ranked = F.array_sort(F.collect_list(F.struct("distinct_values", "column_name")))
    # One row per given column, so the list is as short as the argument.
    return profile.agg(ranked.alias("r")).select(
        F.posexplode("r").alias("position", "c")
    ).select((F.col("position") + 1).alias("position"), "c.column_name", "c.distinct_values")
