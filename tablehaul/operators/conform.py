"""Conforming and cleaning: make a source table fit its declared target schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablehaul.types import spark_type


def conform_types(df: DataFrame, declared: dict[str, str], dialect: str) -> DataFrame:
    """Cast every declared column to the Spark type of its source type."""
    return df.select(*[
        conformed(F.col(name), source_type, dialect).alias(name)
        for name, source_type in declared.items()
    ])


def conformed(c: Column, source_type: str, dialect: str) -> Column:
    """A column cast to the Spark type of its source type."""
    target = spark_type(dialect, source_type)
    if target == "variant":
        return F.parse_json(c.cast("string"))
    if target == "timestamp":
        return F.date_trunc("millisecond", c.cast("timestamp"))
    kind = source_type.upper().split("(")[0].strip()
    if kind in ("CHAR", "CHARACTER", "NCHAR", "BPCHAR"):
        return F.rtrim(c.cast("string"))
    if kind == "INTERVAL":  # microseconds
        return F.unix_micros(F.lit("1970-01-01").cast("timestamp") + c)
    if kind in ("TIME", "TIME WITHOUT TIME ZONE", "TIME WITH TIME ZONE"):
        return F.date_format(c, "HH:mm:ss")
    return c.cast(target)


def case_fold_columns(df: DataFrame) -> DataFrame:
    """Lower-case all column names; names that differ only by case are an error."""
    lowered = [c.lower() for c in df.columns]
    clashes = sorted({c for c in lowered if lowered.count(c) > 1})
    if clashes:
        raise ValueError(f"column names differ only by case: {clashes}")
    return df.toDF(*lowered)


TYPE_DEFAULTS = {
    "string": "", "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00",
    "timestamp_ntz": "1970-01-01 00:00:00",
}


def fill_defaults(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace NULL in the named columns by the default of their type; decimals keep scale."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(TYPE_DEFAULTS.get(types[c], 0)).cast(types[c]))
        for c in columns
    })


def clean_array_nulls(c: Column) -> Column:
    """Elements as text, NULL elements as the empty string."""
    return F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("")))


def array_struct_conform(c: Column, fields: dict[str, str], element_type: str) -> Column:
    """Array of structs with exactly ``fields`` in that order; a NULL array becomes empty."""
    shape = "array<struct<" + ",".join(f"{n}:{t}" for n, t in fields.items()) + ">>"
    filled = F.coalesce(c, F.array().cast(f"array<{element_type}>"))
    return F.transform(
        filled, lambda x: F.struct(*[x[n].cast(t).alias(n) for n, t in fields.items()])
    ).cast(shape)


def json_default(c: Column) -> Column:
    """JSON text as VARIANT; NULL text reads as the empty object."""
    return F.parse_json(F.coalesce(c, F.lit("{}")))


def json_hot_keys(df: DataFrame, column: str, keys: dict[str, tuple[str, str]]) -> DataFrame:
    """Pull JSON paths into typed columns: ``{name: (path, type)}``."""
    parsed = F.parse_json(F.col(column))
    return df.withColumns({n: F.try_variant_get(parsed, p, t) for n, (p, t) in keys.items()})


def struct_flatten(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select(*[c for c in df.columns if c != column], f"{column}.*")


def row_transform(
    df: DataFrame, columns: dict[str, Column], batches: Callable | None = None, schema=None
) -> DataFrame:
    """User transform: column expressions, then optionally a function over Arrow batches."""
    shaped = df.withColumns(columns) if columns else df
    return shaped.mapInPandas(batches, schema) if batches else shaped


def append_columns(df: DataFrame, target: StructType) -> DataFrame:
    """Select the target's columns from ``df`` by name, ignoring case.

    Unknown source columns are dropped. Missing ones become NULL, or the default of their
    type where the target allows no NULL. A source that shares no column with the target is
    an error.
    """
    folded = case_fold_columns(df)
    known = set(folded.columns)
    if not known & {f.name.lower() for f in target.fields}:
        raise ValueError("no source column matches a target column")

    def value(f):
        if f.name.lower() in known:
            return F.col(f.name.lower())
        return F.lit(None if f.nullable else TYPE_DEFAULTS.get(f.dataType.simpleString(), 0))

    return folded.select(*[value(f).cast(f.dataType).alias(f.name) for f in target.fields])
