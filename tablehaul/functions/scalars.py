"""Column helpers for expressions whose meaning differs between warehouse dialects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str, precision: int = 12, scale: int = 2) -> Column:
    """Exact decimal; money is never summed as a double."""
    return _col(c).cast(f"decimal({precision},{scale})")


def pick(values: list[str], index: Column) -> Column:
    """The element of a literal list at a 0-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def trunc_to(unit: str, c: Column | str) -> Column:
    """Start of the unit, as a zone-less timestamp."""
    return F.date_trunc(unit, _col(c)).cast("timestamp_ntz")


def yyyymm(c: Column | str) -> Column:
    c = _col(c)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def month_boundaries(later: Column, earlier: Column) -> Column:
    """Calendar-month boundaries crossed between two dates."""
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("long")


def months_wrapping(later: Column, earlier: Column) -> Column:
    """Whole months modulo a year: the month field of an age."""
    return F.pmod(F.floor(F.months_between(later, earlier)), F.lit(12)).cast("long")


def hours_exact(later: Column, earlier: Column) -> Column:
    """Fractional hours."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(3_600_000_000)


def hours_whole(later: Column, earlier: Column) -> Column:
    """Completed hours."""
    return F.timestamp_diff("HOUR", earlier, later)


def hour_boundaries(later: Column, earlier: Column) -> Column:
    """Hour boundaries crossed."""
    return F.timestamp_diff("HOUR", trunc_to("hour", earlier), trunc_to("hour", later))


def zone_to_utc(local: Column | str, zone: str) -> Column:
    """Local wall-clock time in ``zone`` as a UTC wall-clock time, in milliseconds."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), _col(local).cast("timestamp_ntz"))
    return trunc_to("millisecond", utc)


def ratio_pct(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` in percent; NULL when there is nothing to divide by."""
    return F.round(part.cast("double") * 100 / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def map_text(m: Column | str, key: str) -> Column:
    """Map lookup where an absent key reads as the empty string."""
    return F.coalesce(F.try_element_at(_col(m), F.lit(key)), F.lit(""))


def clean_identifier(c: Column | str) -> Column:
    """Every character outside letters, digits and underscore becomes an underscore."""
    return F.regexp_replace(_col(c), "[^0-9A-Za-z_]", "_")


def hashable(c: Column | str, kind: DataType) -> Column:
    """A column that Spark can hash and order: maps become sorted entries, variants JSON text."""
    c = _col(c)
    if isinstance(kind, VariantType):
        return F.to_json(c)
    if isinstance(kind, MapType):
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(
            hashable(e["key"], kind.keyType).alias("key"),
            hashable(e["value"], kind.valueType).alias("value"),
        )))
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: hashable(x, kind.elementType))
    if isinstance(kind, StructType):
        fields = [hashable(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields)) if fields else c
    return c


def hashable_columns(df: DataFrame) -> list[Column]:
    return [hashable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
