"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A few rollups group on a column derived from the join key; splitting a hot
    # join partition is worth the extra exchange there.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

PARTITION_BYTES = 128 * 1024 * 1024

_test_folder: str | None = None
#: Per application: the partition count it was configured with, and the one set last.
_fitted: dict[str, tuple[int, int]] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job relies on (UTC results, AQE)."""
    for name, value in _RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def fit_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Set the shuffle partition count so that a partition of a query's input fits a task.

    Parquet grows about threefold in memory. AQE merges what turns out small, so the number
    only has to be high enough. It never falls below the configured one, and a small query
    after a large one gets that one back.
    """
    name, app = "spark.sql.shuffle.partitions", spark.sparkContext.applicationId
    current = int(spark.conf.get(name))
    configured, last = _fitted.get(app, (current, current))
    if current != last:  # set by someone else meanwhile
        configured = current
    wanted = max(configured, -(-3 * input_bytes // PARTITION_BYTES))
    if wanted != current:
        spark.conf.set(name, str(wanted))
    _fitted[app] = configured, wanted


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path; 0 when there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.getContentSummary(at).getLength() if store.exists(at) else 0


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a work table's folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the one in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    global _test_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _test_folder is None:
        _test_folder = tempfile.mkdtemp(prefix="tablehaul-")
    return _test_folder


#: Work paths made inside ``work_tables`` blocks, innermost last.
_open_jobs: list[list[str]] = []


@contextlib.contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the work tables that are made inside the block when it ends.

    Results are lazy and may read them, so a job writes its result inside the block.
    """
    made: list[str] = []
    _open_jobs.append(made)
    try:
        yield
    finally:
        _open_jobs.remove(made)
        for path in made:
            delete_path(spark, path)


def work_path(spark: SparkSession, name: str) -> str:
    """A new path for one job's tables under the shared folder."""
    path = f"{shared_folder(spark)}/tablehaul/{name}-{uuid.uuid4().hex[:12]}"
    if _open_jobs:
        _open_jobs[-1].append(path)
    return path


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it from there.

    For results that are used several times: they are computed once, and a lost executor
    costs a re-read, not a re-computation. ``options`` are those of the Parquet writer.
    """
    path = work_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
