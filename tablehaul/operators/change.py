"""Keyed versions: newest row per key and change application."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The newest row per key; ``version`` columns decide, first one first.

    An aggregate, so each input partition already keeps one row per key before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*version)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def latest_changes(
    changes: DataFrame, keys: list[str], version: str, op: str, delete: str = "D"
) -> DataFrame:
    """The change of each key that counts.

    The highest version wins and NULL is below every version. At equal versions a delete wins
    over other operations, and what is still equal is decided by a hash of the row, so that
    repeated runs and streams agree.
    """
    rank = F.struct(version, F.coalesce(F.col(op) == delete, F.lit(False)), F.xxhash64(*changes.columns))
    ranked = changes.withColumn("_rank", rank)
    return dedup_latest(ranked, keys, ["_rank"]).drop("_rank")


def cdc_apply(
    base: DataFrame, changes: DataFrame, keys: list[str], version: str, op: str, delete: str = "D"
) -> DataFrame:
    """Apply inserts, updates and deletes to a keyed table.

    Only the newest change of a key counts (see ``latest_changes``), and only when it is newer
    than the base row, so the order of arrival and repeated changes make no difference. A
    change without a version is newer than nothing: it inserts a key that is not there and
    leaves every row that is. A base row without a version is older than every version.
    """
    values = [c for c in base.columns if c not in keys]
    latest = latest_changes(changes.select(*keys, *values, op), keys, version, op, delete)
    change = latest.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.struct(*values).alias("_new"), F.col(op).alias("_op"),
    )
    old = base.select(*keys, F.struct(*values).alias("_old"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    new_version, old_version = F.col(f"_new.{version}"), F.col(f"_old.{version}")
    newer = new_version.isNotNull() & (old_version.isNull() | (new_version > old_version))
    wins = F.col("_new").isNotNull() & (F.col("_old").isNull() | newer)
    gone = F.col("_wins") & F.coalesce(F.col("_op") == delete, F.lit(False))
    return (
        old.join(change, same, "full")
        .withColumn("_wins", F.coalesce(wins, F.lit(False))).filter(~gone)
        .select(
            *[F.coalesce(k, f"_k_{k}").alias(k) for k in keys],
            F.when(F.col("_wins"), F.col("_new")).otherwise(F.col("_old")).alias("_row"),
        )
        .select(*keys, "_row.*")
    )
