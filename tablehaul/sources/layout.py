"""Physical layout of target tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablehaul.functions.scalars import hashable_columns, yyyymm
from tablehaul.session import delete_path


def write_partition_sorted(
    df: DataFrame, path: str, time: str, keys: list[str], bloom: tuple[str, ...] = (),
    rows_per_file: int = 0, folders: bool = True,
) -> None:
    """Month folders with key-sorted files.

    Rows are range-partitioned by month and keys, so a large month is spread over several
    tasks and files, each a narrow key range that min/max statistics can skip. The row hash
    comes last: it spreads the rows of one hot key, and unlike a random number it puts a row
    into the same range again when a lost task is repeated. ``bloom`` columns get a Bloom
    filter for point lookups. Without ``folders`` the files are cut and sorted in the same way
    but the table keeps exactly its columns.
    """
    month = yyyymm(time)
    placed = df.withColumn("ym", month) if folders else df
    placed = (
        placed.repartitionByRange(month, *keys, F.xxhash64(*hashable_columns(df)))
        .sortWithinPartitions(month, *keys)
    )
    writer = placed.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if folders:
        writer = writer.partitionBy("ym")
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def month_filter(time: str, start: str, end: str):
    """A date range, plus the range of month folders it can touch."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    day = F.col(time)
    inside = (day >= first) & (day < last)
    return inside & F.col("ym").between(yyyymm(first), yyyymm(F.date_sub(last, 1)))


class CopyMismatch(RuntimeError):
    """A rebuilt copy does not have the rows and columns of the original."""


def contents(df: DataFrame) -> tuple:
    """Row count and sums of row hashes, the same for the same rows in any order."""
    h = F.xxhash64(*hashable_columns(df))
    low = F.lit(2**31 - 1)
    row = df.select(h.alias("h")).agg(
        F.count(F.lit(1)), F.sum(F.col("h").bitwiseAND(low)), F.sum(F.shiftrightunsigned("h", 33))
    ).first()
    return tuple(row)


def swap_rebuild(
    spark: SparkSession, table: str, folder: str, write: Callable[[DataFrame, str], None]
) -> DataFrame:
    """Change an external Parquet table's layout: write a copy, verify it, point the table to it.

    The copy must have the same columns and the same rows by count and hash. The table then
    gets the new location in one step, so its name and columns are always there, and a failed
    copy leaves the original in place.
    """
    original = spark.table(table)
    path = f"{folder}/{table}-{uuid.uuid4().hex[:8]}"
    write(original, path)
    rebuilt = spark.read.parquet(path)
    if rebuilt.dtypes != original.dtypes:
        raise CopyMismatch(f"{table}: copy at {path} has other columns")
    if contents(rebuilt) != contents(original):
        raise CopyMismatch(f"{table}: copy at {path} has other rows")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def replace_version(df: DataFrame, root: str, version: int) -> None:
    """Write a numbered version of a table and then announce it.

    Readers follow the announcements, so they keep the old version until the new one is
    complete, and a failed write is never seen. Writing a version again replaces it.
    """
    path = f"{root}/data-{version}-{uuid.uuid4().hex[:8]}"
    df.write.mode("overwrite").parquet(path)
    announced = df.sparkSession.createDataFrame([(version, path)], "version bigint, path string")
    announced.coalesce(1).write.mode("overwrite").parquet(f"{root}/versions/n={version}")


def newest_version(
    spark: SparkSession, root: str, below: int | None = None
) -> tuple[int, DataFrame]:
    """Number and rows of the newest announced version, or of the newest one below a number."""
    versions = spark.read.parquet(f"{root}/versions")
    if below is not None:
        versions = versions.filter(F.col("version") < below)
    newest = versions.orderBy(F.desc("version")).first()
    return newest["version"], spark.read.parquet(newest["path"])


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all but the newest versions; those kept serve readers that started before."""
    rows = spark.read.parquet(f"{root}/versions").orderBy(F.desc("version")).collect()
    for old in rows[keep:]:  # as many rows as versions, which this keeps few
        delete_path(spark, f"{root}/versions/n={old['version']}")
        delete_path(spark, old["path"])


def current_version(spark: SparkSession, root: str) -> DataFrame:
    """The newest announced version of a table written by ``replace_version``."""
    return newest_version(spark, root)[1]


FOLDER = "_folder"
ANNOUNCED = "version bigint, folder string, path string"


def _announced(spark: SparkSession, root: str) -> list:
    """All announcements of a foldered table, one row per version and folder; few versions stay."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/versions")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return []
    return spark.read.schema(ANNOUNCED).parquet(f"{root}/versions").collect()


def newest_folders(spark: SparkSession, root: str, below: int | None = None) -> dict[str, str]:
    """Folder names and paths of the newest version written by ``replace_folders``, or of the
    newest one below a number."""
    rows = [r for r in _announced(spark, root) if below is None or r["version"] < below]
    newest = max((r["version"] for r in rows), default=None)
    return {r["folder"]: r["path"] for r in rows if r["version"] == newest and r["path"]}


def read_folders(
    spark: SparkSession, root: str, schema: StructType, below: int | None = None,
    only: list[str] | None = None,
) -> DataFrame:
    """Rows of the newest version (see ``newest_folders``); ``only``: of these folders."""
    folders = newest_folders(spark, root, below)
    paths = [p for f, p in folders.items() if only is None or f in set(only)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def replace_folders(df: DataFrame, root: str, version: int, touched: list[str]) -> None:
    """A new version of a table in which only the ``touched`` folders are written anew.

    ``df`` has the rows of those folders and says which in a string column ``_folder``. All other
    folders are those of the newest version before, referenced and not copied. As with
    ``replace_version``, readers follow the announcements and a version may be written again.
    """
    spark = df.sparkSession
    data = f"{root}/data-{version}-{uuid.uuid4().hex[:8]}"
    # Any text may name a folder; the file system sees its hash.
    placed = df.withColumn(FOLDER, F.sha1(FOLDER))
    # Rebalancing gives small folders one file and shares a large one among tasks.
    placed.hint("rebalance", FOLDER).write.mode("overwrite").partitionBy(FOLDER).parquet(data)
    written = _children(spark, data)
    place = {f: f"{FOLDER}={hashlib.sha1(f.encode()).hexdigest()}" for f in touched}
    kept = {f: p for f, p in newest_folders(spark, root, below=version).items() if f not in place}
    kept |= {f: f"{data}/{p}" for f, p in place.items() if p in written}
    # A version of no folder is announced too.
    rows = [(version, f, p) for f, p in sorted(kept.items())] or [(version, None, None)]
    announced = spark.createDataFrame(rows, ANNOUNCED)
    announced.coalesce(1).write.mode("overwrite").parquet(f"{root}/versions/n={version}")


def _children(spark: SparkSession, path: str) -> set[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in store.listStatus(at)} if store.exists(at) else set()


def drop_folders(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all but the newest versions and the folders that only those held."""
    rows = _announced(spark, root)
    numbers = sorted({r["version"] for r in rows}, reverse=True)
    held = {r["path"] for r in rows if r["version"] in numbers[:keep] and r["path"]}
    used = {p.rsplit("/", 1)[0] for p in held}
    old = {r["path"] for r in rows if r["path"]} - held
    for path in {p if p.rsplit("/", 1)[0] in used else p.rsplit("/", 1)[0] for p in old}:
        delete_path(spark, path)
    for number in numbers[keep:]:
        delete_path(spark, f"{root}/versions/n={number}")
