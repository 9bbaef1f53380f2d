"""The event log of runs: an append-only Parquet folder."""

from __future__ import annotations

import datetime as dt
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.operators.validate import validation_summary
from tablehaul.session import saved, stored_bytes

EVENT = "id bigint, run_id string, ts timestamp_ntz, kind string, payload_json string"


class Ledger:
    """Events of one run. They are gathered on the driver (a few per table) and appended
    whenever a table is finished; ids are microseconds and always grow."""

    def __init__(self, spark: SparkSession, path: str | None, run_id: str):
        self.spark, self.path, self.run_id = spark, path, run_id
        self._last = 0
        self._waiting: list[tuple] = []

    def add(self, kind: str, **payload) -> None:
        self._last = max(self._last + 1, time.time_ns() // 1000)
        at = dt.datetime.fromtimestamp(self._last / 1e6, dt.timezone.utc).replace(tzinfo=None)
        kept = {k: v for k, v in payload.items() if v is not None}
        self._waiting.append((self._last, self.run_id, at, kind, json.dumps(kept)))

    def append_rows(self, rows: DataFrame, kind: str) -> None:
        """Append any result (validation rows, benchmark rows) as one event per row.

        Ids go on densely from the run's last one, so events added later come after them.
        """
        self.flush()
        if not self.path:
            return
        first = max(self._last + 1, time.time_ns() // 1000)
        self._last = first - 1 + _append_from(rows, self.path, self.run_id, kind, first)

    def flush(self) -> None:
        if self.path and self._waiting:
            events = self.spark.createDataFrame(self._waiting, EVENT)
            events.coalesce(1).write.mode("append").parquet(self.path)
        self._waiting = []


class ValidationFailed(RuntimeError):
    """A validation found tables that differ or cannot be read."""


def record_validation(parity: DataFrame, ledger: Ledger, raise_on_mismatch: bool = False) -> dict[str, int]:
    """Leave a validation in the run's ledger: a row event per table, then its summary.

    ``parity`` has ``table_name, matched, error`` (see ``row_count_parity``) and is computed once.
    The summary counts matched, mismatched, errored and all tables; the run counts as validated
    when it is written. With ``raise_on_mismatch`` anything but a full match raises afterwards.
    """
    rows = saved(parity, "validation")
    ledger.append_rows(rows, "validation_row")
    summary = validation_summary(rows).first().asDict()
    for kind in ("validation_done", "step_validated"):
        ledger.add(kind, **summary)
    ledger.flush()
    if raise_on_mismatch and summary["matched"] < summary["total"]:
        raise ValidationFailed(
            f"run {ledger.run_id}: {summary['mismatched']} tables differ, {summary['errored']} failed"
        )
    return summary


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT).parquet(path)


def _append_from(rows: DataFrame, path: str, run_id: str, kind: str, first: int) -> int:
    """Append one event per row with ids from ``first`` on; returns the number of rows."""
    numbered = saved(
        rows.select(
            F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
            F.to_json(F.struct(*rows.columns)).alias("payload_json"),
        ),
        "ledger-rows",
    )
    # One number per partition comes to the driver.
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["part"], total))
        total += r["n"]
    if not total:
        return 0
    begin = rows.sparkSession.createDataFrame(starts, "part int, start long")
    # The low 33 bits of the place count the rows of a partition.
    place = F.col("start") + F.col("place").bitwiseAND(F.lit(2**33 - 1))
    numbered.join(F.broadcast(begin), "part").select(
        (F.lit(first) + place).alias("id"), F.lit(run_id).alias("run_id"),
        F.current_timestamp().cast("timestamp_ntz").alias("ts"), F.lit(kind).alias("kind"),
        "payload_json",
    ).write.mode("append").parquet(path)
    return total


def append_rows(rows: DataFrame, path: str, run_id: str, kind: str) -> None:
    """Append rows as events to a ledger that has no open ``Ledger``; ids go on from its last."""
    last = read_ledger(rows.sparkSession, path).agg(F.max("id")).first()[0] if stored_bytes(
        rows.sparkSession, path
    ) else None
    first = max((last or 0) + 1, time.time_ns() // 1000)
    _append_from(rows, path, run_id, kind, first)
