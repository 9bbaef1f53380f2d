"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.session import saved

BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a table's size; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_checked(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the table's estimated size allows it.

    Past the bound the table is returned as it is and the join shuffles both sides.
    """
    return F.broadcast(df) if estimated_bytes(df) <= most_bytes else df


def left_join_many(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to a side that may hold very many rows of one key.

    Spark splits a skewed side of an inner join, but not the right side of a left join, so
    the matches come from an inner join and the rest from an anti join to the distinct keys.
    Both inputs are stored first, since each is read twice.
    """
    left, right = saved(left, "left-side"), saved(right, "right-side")
    matched = left.join(right, keys)
    lonely = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition under which NULL keys equal each other."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition
