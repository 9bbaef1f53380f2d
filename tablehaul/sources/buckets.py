"""Keyed tables that change in place, bucket by bucket.

A table is a catalog table of Parquet files, bucketed and sorted by its keys, with one folder per
bucket. A scan of it is already partitioned and sorted by key, so changes are shuffled to the
table and not the table to the changes; and a batch of changes rewrites the folders of the
buckets that its keys fall into, by dynamic partition overwrite, and leaves all others as they
are. The work of a batch thus follows the buckets it touches, not the size of the table.

Deleted keys stay as rows without a life (``GONE``), so that an older change that arrives later
finds them; readers never see them. Every batch may be applied again: what is not newer than the
stored row changes nothing.
"""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.operators.change import latest_changes
from tablehaul.session import PARTITION_BYTES, delete_path, saved, stored_bytes

BUCKET, GONE, MARK = "bucket", "_gone", "_change_hash"


@contextlib.contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwriting replaces the partitions that are written and no others."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def buckets_for(input_bytes: int) -> int:
    """Buckets in which a table of so many stored bytes fits the memory of one task each."""
    return max(8, -(-3 * input_bytes // PARTITION_BYTES))


class BucketedTable:
    """A catalog table with one row per key.

    ``version`` orders the changes of a key. A row from a change also keeps the hash of the
    change, by which changes with equal versions are told apart as in one batch.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, keys: list[str], version: str):
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
            raise ValueError(f"not a bare table name: {name!r}")
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self.keys, self.version = keys, version

    def create(self, rows: DataFrame, buckets: int | None = None) -> BucketedTable:
        """Store the first rows, one per key; ``buckets`` stays as it is for the table's life."""
        if buckets is None:
            size = sum(stored_bytes(self.spark, f) for f in rows.inputFiles())
            buckets = buckets_for(size)
        placed = rows.withColumns({
            GONE: F.lit(False), MARK: F.lit(None).cast("long"), BUCKET: self._bucket(buckets),
        })
        (
            placed.repartition(buckets, *self.keys).write.mode("overwrite").format("parquet")
            .option("path", self.path).partitionBy(BUCKET).bucketBy(buckets, *self.keys)
            .sortBy(*self.keys).saveAsTable(self.name)
        )
        return self

    def _bucket(self, buckets: int) -> Column:
        """The bucket that Spark's own hash partitioning gives the keys."""
        return F.pmod(F.hash(*self.keys), F.lit(buckets))

    @property
    def buckets(self) -> int:
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.name}").filter("col_name = 'Num Buckets'")
        return int(rows.first()["data_type"])

    def _stored(self) -> DataFrame:
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        """The rows that live."""
        return self._stored().filter(~F.col(GONE)).drop(GONE, MARK, BUCKET)

    def merged(
        self, changes: DataFrame, op: str, delete: str = "D", touched: list[int] | None = None,
    ) -> DataFrame:
        """Stored rows with changes applied, gone ones included, without an exchange of the table.

        ``touched``: only rows of these buckets. Keys that hold a NULL cannot be found by a plain
        join and take a way of their own, which shuffles only such rows.
        """
        latest = self._as_rows(changes, op, delete)
        stored = self._stored()
        if touched is not None:
            stored = stored.filter(F.col(BUCKET).isin(touched))
        whole = F.lit(True)
        for k in self.keys:
            whole = whole & F.col(k).isNotNull()
        plain = self._joined(stored.filter(whole), latest.filter(whole), null_safe=False)
        return plain.unionByName(self._joined(stored.filter(~whole), latest.filter(~whole), null_safe=True))

    def _as_rows(self, changes: DataFrame, op: str, delete: str) -> DataFrame:
        """The change of each key that counts, as a row of the table."""
        values = [c for c in self._stored().columns if c not in (GONE, MARK, BUCKET)]
        latest = latest_changes(changes.select(*values, op), self.keys, self.version, op, delete)
        return latest.select(
            *values, F.coalesce(F.col(op) == delete, F.lit(False)).alias(GONE),
            F.xxhash64(*values, op).alias(MARK), self._bucket(self.buckets).alias(BUCKET),
        )

    def _joined(self, stored: DataFrame, latest: DataFrame, null_safe: bool) -> DataFrame:
        rest = [c for c in stored.columns if c not in self.keys]
        new = latest.select(
            *[F.col(k).alias(f"_k_{k}") for k in self.keys], F.struct(*rest).alias("_new")
        )
        same = F.lit(True)
        for k in self.keys:
            pair = stored[k], new[f"_k_{k}"]
            same = same & (pair[0].eqNullSafe(pair[1]) if null_safe else pair[0] == pair[1])
        newer = F.coalesce(self._newer(), F.lit(False))
        # Both joins keep the table's own partitioning: a left one for the rows that are there, an
        # anti one for the keys that are not.
        kept = stored.withColumn("_old", F.struct(*rest)).join(new, same, "left").select(
            *self.keys, F.when(newer, F.col("_new")).otherwise(F.col("_old")).alias("_row")
        ).select(*self.keys, "_row.*")
        there = stored.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys])
        same = F.lit(True)
        for k in self.keys:
            pair = latest[k], there[f"_k_{k}"]
            same = same & (pair[0].eqNullSafe(pair[1]) if null_safe else pair[0] == pair[1])
        added = latest.join(there, same, "left_anti")
        return kept.unionByName(added.select(*kept.columns))

    def _newer(self) -> Column:
        """Whether a change counts more than the stored row; NULL where there is no change.

        A higher version does, and NULL is below every version. At equal versions a row that is
        no change stays; of two changes the delete counts, then the larger hash.
        """
        new, old = F.col(f"_new.{self.version}"), F.col(f"_old.{self.version}")
        later = new.isNotNull() & (old.isNull() | (new > old))
        rank = [F.struct(F.col(f"{side}.{GONE}"), F.col(f"{side}.{MARK}")) for side in ("_new", "_old")]
        tie = new.eqNullSafe(old) & F.col(f"_old.{MARK}").isNotNull() & (rank[0] > rank[1])
        return F.col("_new").isNotNull() & (later | tie)

    def apply(self, changes: DataFrame, op: str, delete: str = "D") -> list[int]:
        """Apply a batch of changes; returns the buckets that were rewritten."""
        values = [c for c in self._stored().columns if c not in (GONE, MARK, BUCKET)]
        own = saved(latest_changes(changes.select(*values, op), self.keys, self.version, op, delete), "batch")
        touched = sorted(r[0] for r in own.select(self._bucket(self.buckets)).distinct().collect())
        if not touched:
            return []
        rows = self.merged(own, op, delete, touched).select(*self._stored().columns)
        with dynamic_overwrite(self.spark):
            rows.write.mode("overwrite").insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        return touched

    def drop(self) -> None:
        """Forget the table and delete its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.path)
