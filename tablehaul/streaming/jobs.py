"""Structured Streaming jobs that maintain tables from arriving files.

``foreachBatch`` may run a batch again after a failure, so every batch writes to a folder
of its own number and a second run replaces the first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablehaul.operators.change import cdc_apply, dedup_latest, latest_changes
from tablehaul.operators.progress import kpis, parsed_once, run_states, run_tables
from tablehaul.operators.rollup import Rollup, rollup_build, rollup_compact, rollup_merge
from tablehaul.session import delete_path, saved, work_tables
from tablehaul.sources.buckets import BucketedTable
from tablehaul.sources.layout import (
    FOLDER, current_version, drop_folders, drop_versions, newest_version, read_folders,
    replace_folders, replace_version,
)

BATCH = "batch_id"
LOG_BUCKETS = 256
#: Events of a bucket that one task writes, about.
BUCKET_ROWS = 500_000
#: Batches of the event log that are merged into its compacted part at once.
FOLD_EVERY = 16


def read_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet file or folder as a stream of its files, and nothing beside it.

    A stream's source must be a folder or a pattern, so a single file is named by a pattern
    that only it matches. Without ``files_per_batch`` a batch takes all files that have arrived.
    """
    schema = spark.read.parquet(path).schema
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at)
    source = path if status.isDirectory() else f"{path[:-1]}[{path[-1]}]"
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.parquet(source)


def _start(stream: DataFrame, handle, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return trigger.start()


def _write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/batches/{BATCH}={batch_id}")
    if batch_id == 0:  # nothing is folded yet
        replace_version(df.filter(F.lit(False)), f"{root}/folded", -1)


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """Everything written so far: the folded past and the batches after it."""
    batches = spark.read.parquet(f"{root}/batches")
    upto, folded = newest_version(spark, f"{root}/folded")
    return folded.unionByName(batches.filter(F.col(BATCH) > upto).drop(BATCH))


def fold_batches(spark: SparkSession, root: str, fold: Callable[[DataFrame], DataFrame]) -> None:
    """Compact a stream's output, so that reads do not slow down with the number of batches.

    ``fold`` must keep everything later batches can still meet: partial states stay states,
    and deleted keys stay as delete changes. Batch folders that the fold before this one holds
    are deleted, as nobody can still be reading them; a batch that runs again after that
    rewrites a folder nobody reads any more.
    """
    before, _ = newest_version(spark, f"{root}/folded")
    batches = [r[0] for r in spark.read.parquet(f"{root}/batches").select(BATCH).distinct().collect()]
    replace_version(fold(read_batches(spark, root)), f"{root}/folded", max([before, *batches]))
    for old in batches:
        if old <= before:
            delete_path(spark, f"{root}/batches/{BATCH}={old}")
    drop_versions(spark, f"{root}/folded")


def stream_rollup(
    stream: DataFrame, spec: Rollup, states: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Each batch of rows adds its partial states; late rows just add more."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        _write_batch(rollup_build(batch, spec), states, batch_id)

    return _start(stream, handle, checkpoint, every)


def fold_rollup(spark: SparkSession, states: str, spec: Rollup) -> None:
    fold_batches(spark, states, lambda df: rollup_compact(df, spec))


def read_rollup(spark: SparkSession, states: str, spec: Rollup) -> DataFrame:
    return rollup_merge(read_batches(spark, states), spec)


def stream_cdc(
    changes: DataFrame, keys: list[str], version: str, op: str, log: str, checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Keep each batch's newest change per key; readers merge them into the base table."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        _write_batch(latest_changes(batch, keys, version, op), log, batch_id)

    return _start(changes, handle, checkpoint, every)


def fold_cdc(spark: SparkSession, log: str, keys: list[str], version: str, op: str) -> None:
    fold_batches(spark, log, lambda df: latest_changes(df, keys, version, op))


def read_cdc(
    spark: SparkSession, base: DataFrame, log: str, keys: list[str], version: str, op: str
) -> DataFrame:
    return cdc_apply(base, read_batches(spark, log), keys, version, op)


def stream_cdc_table(
    changes: DataFrame, table: BucketedTable, op: str, checkpoint: str, every: str | None = None,
) -> StreamingQuery:
    """Apply each batch of changes to a stored table; only the buckets it touches are rewritten.

    A batch that runs again finds nothing newer than what it has stored.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        with work_tables(batch.sparkSession):
            table.apply(batch, op)

    return _start(changes, handle, checkpoint, every)


def stream_refresh_lagged(
    stream: DataFrame, spec: Rollup, root: str, checkpoint: str, lag: str | None = "1 hour",
    folder: Column | None = None,
) -> StreamingQuery:
    """A table that is at most ``lag`` behind: new states, then a new version of the result.

    ``folder`` is computed from the rollup's keys (such as a day or month) and cuts states and
    results into folders. A batch merges its states with those of the folders it touches and
    writes these folders only; a version references all others as they are. Without it everything
    lies in one folder. So a batch's work follows the folders it touches, not the table.
    """
    states, table = f"{root}/states", f"{root}/table"
    named = F.lit("all") if folder is None else F.coalesce(folder.cast("string"), F.lit(""))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with work_tables(spark):
            new = saved(rollup_build(batch, spec), "batch-states")
            touched = [r[0] for r in new.select(named.alias(FOLDER)).distinct().collect()]
            old = read_folders(spark, states, new.schema, below=batch_id, only=touched)
            both = saved(rollup_compact(new.unionByName(old), spec), "folder-states")
            replace_folders(both.withColumn(FOLDER, named), states, batch_id, touched)
            result = rollup_merge(both, spec)
            replace_folders(result.withColumn(FOLDER, named), table, batch_id, touched)
            if batch_id == 0:  # readers learn the columns from it
                result.limit(0).write.mode("overwrite").parquet(f"{root}/columns")
        # A batch that runs again needs the version before it, so two stay.
        drop_folders(spark, states)
        drop_folders(spark, table)

    return _start(stream, handle, checkpoint, lag)


def read_refreshed(spark: SparkSession, root: str) -> DataFrame:
    return read_folders(spark, f"{root}/table", spark.read.parquet(f"{root}/columns").schema)


def stream_events_tail(
    events: DataFrame, since: int, sink: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Follow an event log from an id."""
    writer = (
        events.filter(F.col("id") > since).writeStream.format("parquet")
        .option("path", sink).option("checkpointLocation", checkpoint)
    )
    trigger = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return trigger.start()


def _write_buckets(events: DataFrame, path: str) -> None:
    """Write events into the folders of their buckets, one task for each ``BUCKET_ROWS`` counted
    in a bucket, so that a run with very many events is shared by several tasks."""
    counted = events.groupBy("bucket").count().collect()
    tasks = F.lit(1)
    for bucket, n in counted:
        if n > BUCKET_ROWS:
            tasks = F.when(F.col("bucket") == bucket, -(-n // BUCKET_ROWS)).otherwise(tasks)
    salt = F.pmod(F.xxhash64("id"), tasks)
    events.repartition("bucket", salt).write.mode("overwrite").partitionBy("bucket").parquet(path)


def _fold_log(spark: SparkSession, log: str, batch_id: int) -> None:
    """Merge the log's batches into its compacted part, sorted into the same run buckets.

    Only the newest compacted part and the batches after it are read. Parts before the last
    two, and the batches they hold, are deleted.
    """
    folded = newest_version(spark, f"{log}/folded")[0] if batch_id >= FOLD_EVERY else -1
    events = _log_events(spark, log, batch_id)
    path = f"{log}/folded/data-{batch_id}"
    _write_buckets(events, path)
    announced = spark.createDataFrame([(batch_id, path)], "version bigint, path string")
    announced.coalesce(1).write.mode("overwrite").parquet(f"{log}/folded/versions/n={batch_id}")
    drop_versions(spark, f"{log}/folded")
    for old in range(max(0, folded - FOLD_EVERY + 1), folded + 1):
        delete_path(spark, f"{log}/batches/{BATCH}={old}")


def _log_events(spark: SparkSession, log: str, batch_id: int) -> DataFrame:
    """All events up to a batch: the newest compacted part before it and the batches since."""
    upto = batch_id // FOLD_EVERY * FOLD_EVERY - 1  # the last batch that was merged before it
    paths = [f"{log}/batches/{BATCH}={b}" for b in range(upto + 1, batch_id + 1)]
    recent = [spark.read.option("basePath", p).parquet(p) for p in paths]
    if upto >= 0:
        recent.append(newest_version(spark, f"{log}/folded", below=batch_id)[1])
    return reduce(DataFrame.unionByName, recent)


def stream_progress_kpis(
    events: DataFrame, totals: DataFrame, log: str, out: str, checkpoint: str, as_of,
    every: str | None = None,
) -> StreamingQuery:
    """Append events to a log and refresh the figures of the runs a batch touched.

    Events may arrive in any order, so the figures are computed from all events of a run. The
    log is foldered by a hash of the run, only folders of touched runs are read, and every
    ``FOLD_EVERY`` batches it is compacted. The figures are a versioned table with one row a
    run. So a batch opens a number of files that does not grow with the stream's age.
    """
    bucket = F.pmod(F.xxhash64("run_id"), F.lit(LOG_BUCKETS)).cast("int")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{log}/batches/{BATCH}={batch_id}"
        _write_buckets(batch.withColumn("bucket", bucket), path)
        written = spark.read.schema("run_id string, bucket int").parquet(path)
        touched = written.select("run_id").distinct()
        buckets = [r["bucket"] for r in written.select("bucket").distinct().collect()]
        # A repeated batch does not see later ones, or its figures would differ.
        known = _log_events(spark, log, batch_id).filter(F.col("bucket").isin(buckets)).drop("bucket")
        with work_tables(spark):
            known = parsed_once(known.join(touched, "run_id", "left_semi"))
            tables = run_tables(known, totals.join(touched, "run_id", "left_semi"))
            figures = kpis(known, tables, run_states(known, as_of)).withColumn(BATCH, F.lit(batch_id))
            if batch_id > 0:
                figures = figures.unionByName(newest_version(spark, out, below=batch_id)[1])
            replace_version(dedup_latest(figures, ["run_id"], [BATCH]), out, batch_id)
        drop_versions(spark, out)
        if (batch_id + 1) % FOLD_EVERY == 0:
            _fold_log(spark, log, batch_id)

    return _start(events, handle, checkpoint, every)


def read_kpis(spark: SparkSession, out: str) -> DataFrame:
    """Latest figures of every run."""
    return current_version(spark, out).drop(BATCH)
