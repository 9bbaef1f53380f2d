"""Loading staged files as a stream, so that a running load tells how far it has come.

The load is an available-now stream over the staged files. Each micro-batch takes a share of the
files, counts its rows and the bytes of its files while it writes them, and a query listener
hands these figures on as they arrive. The file sink's manifest decides which files count; when
the load has ended the folder is sealed, and is an ordinary Parquet folder from then on.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from tablehaul.session import delete_path

#: Micro-batches of a load: at least so many where there are as many files, one for each
#: ``STEP_BYTES`` of the staged files, and never more than ``MOST_STEPS``.
LEAST_STEPS, MOST_STEPS = 4, 100
STEP_BYTES = 256 * 1024 * 1024
#: Seconds that a load waits for the figures of its last batch.
PATIENCE = 30.0

_BYTES = "_load_bytes"

#: Called with the rows and bytes loaded so far.
Report = Callable[[int, int], None]


class _Figures(StreamingQueryListener):
    """Adds up what the batches of one query have observed; each batch counts once."""

    def __init__(self, name: str, report: Report):
        self.name, self.report = name, report
        self.rows = self.bytes = 0
        self.batches: set[int] = set()
        self.ended: set[str] = set()
        self.changed = threading.Condition(threading.RLock())

    def take(self, batch: int, seen) -> None:
        with self.changed:
            if seen is None or batch in self.batches:
                return
            self.batches.add(batch)
            self.rows += seen["rows"]
            self.bytes += seen["bytes"] or 0
            self.report(self.rows, self.bytes)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            self.take(event.progress.batchId, event.progress.observedMetrics.get(self.name))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def finish(self, query: StreamingQuery) -> None:
        """Wait for the last figures; what the listener was not told is in the query's own record."""
        with self.changed:
            self.changed.wait_for(lambda: str(query.runId) in self.ended, PATIENCE)
        for progress in query.recentProgress:
            self.take(progress.batchId, progress.observedMetrics.get(self.name))


def seal(spark: SparkSession, folder: str) -> None:
    """Make a file sink's folder an ordinary one: only the files of its manifest stay."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    counted = {p.rsplit("/", 1)[1] for p in spark.read.parquet(folder).inputFiles()}
    for status in store.listStatus(at):
        name = status.getPath().getName()
        if status.isFile() and not name.startswith(("_", ".")) and name not in counted:
            store.delete(status.getPath(), False)
    delete_path(spark, f"{folder}/_spark_metadata")


def stream_load(
    spark: SparkSession, staged: str, target: str, shape: Callable[[DataFrame], DataFrame],
    file_count: int, total_bytes: int, report: Report,
) -> int:
    """Load staged Parquet files into a folder, which is replaced; returns the rows loaded.

    ``shape`` turns staged rows into the target's. A load that fails leaves a folder without
    seal, which the next try replaces.
    """
    name = f"load-{uuid.uuid4().hex[:12]}"
    schema: StructType = spark.read.parquet(staged).schema
    steps = min(MOST_STEPS, max(LEAST_STEPS, -(-total_bytes // STEP_BYTES)))
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, -(-file_count // steps)))
    # The first row of each file brings the bytes of the whole file.
    size = F.when(F.col("_metadata.row_index") == 0, F.col("_metadata.file_size"))
    seen = files.parquet(staged).withColumn(_BYTES, size).observe(
        name, F.count(F.lit(1)).alias("rows"), F.sum(_BYTES).alias("bytes")
    ).drop(_BYTES)
    delete_path(spark, target)
    checkpoint = f"{staged.rstrip('/')}-{name}"
    figures = _Figures(name, report)
    spark.streams.addListener(figures)
    try:
        query = (
            shape(seen).writeStream.format("parquet").queryName(name).option("path", target)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        figures.finish(query)
    finally:
        spark.streams.removeListener(figures)
        delete_path(spark, checkpoint)
    seal(spark, target)
    return figures.rows
