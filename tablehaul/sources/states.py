"""Stored tables of rollup states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField

from tablehaul.operators.rollup import Rollup, rollup_compact
from tablehaul.session import saved
from tablehaul.sources.buckets import dynamic_overwrite


def repeated_folders(states: DataFrame, spec: Rollup, folder: str) -> DataFrame:
    """Folders in which a key has more than one state row. Only keys are read."""
    keys = list(dict.fromkeys([folder, *spec.keys]))
    counted = states.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter("_rows > 1").select(folder).distinct()


def _as_stored(value: Column, kind: DataType, field: StructField) -> Column:
    if kind == field.dataType:
        return value
    stored = value.try_cast(field.dataType)
    lost = F.raise_error(F.lit(f"a folded {field.name} does not fit {field.dataType.simpleString()}"))
    return F.when(value.isNotNull() & stored.isNull(), lost).otherwise(stored).alias(field.name)


def compact_folders(spark: SparkSession, path: str, spec: Rollup, folder: str) -> list:
    """Fold the repeated state rows of a table that is partitioned by ``folder``.

    Only folders with repeated keys are read whole, folded and overwritten, by dynamic partition
    overwrite; the others keep their files. ``folder`` follows from the keys, so a key lies in one
    folder. Returns the folders' values, of which the driver gets one each.
    """
    states = spark.read.parquet(path)
    again = [r[0] for r in repeated_folders(states, spec, folder).collect()]
    if not again:
        return []
    chosen = F.col(folder).isin([v for v in again if v is not None])
    if None in again:
        chosen = chosen | F.col(folder).isNull()
    keys = list(dict.fromkeys([*spec.keys, folder]))
    folded = rollup_compact(states.filter(chosen), Rollup(
        keys, spec.counts, spec.sums, spec.averages, spec.distincts, spec.quantiles
    ))
    # A sum of decimals is wider than they are, but all files of a table have the same types.
    same = [_as_stored(F.col(f.name), folded.schema[f.name].dataType, f) for f in states.schema]
    # Written aside first, since the folders that are read are those that are replaced.
    kept = saved(folded.select(*same), "folded-states")
    with dynamic_overwrite(spark):
        kept.hint("rebalance", folder).write.mode("overwrite").partitionBy(folder).parquet(path)
    return again
