"""Whole migrations: copy several tables, check every count, report one row per table."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablehaul import fixed_values as fv
from tablehaul.operators.conform import append_columns, row_transform
from tablehaul.operators.joins import estimated_bytes
from tablehaul.sources.files import stage_export, stage_path
from tablehaul.sources.ledger import Ledger
from tablehaul.sources.load import LEAST_STEPS, stream_load

RESULT = (
    "table_name string, strategy string, source_rows bigint, target_rows bigint, "
    "matched boolean, status string, error string"
)


@dataclass(frozen=True)
class TablePlan:
    """One table to move. The strategy is ``direct``, ``staged`` or ``auto`` (by row count)."""

    name: str
    source: DataFrame
    target_schema: StructType | None = None
    transform: dict[str, Column] = field(default_factory=dict)
    strategy: str = "auto"
    dimension: bool = False

    def __post_init__(self):
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", self.name):
            raise ValueError(f"not a bare table name: {self.name!r}")

    def shaped(self, df: DataFrame) -> DataFrame:
        out = row_transform(df, self.transform)
        return append_columns(out, self.target_schema) if self.target_schema else out


class Migration:
    """Moves tables into Parquet folders below ``target``; dimensions go first.

    Every copy overwrites its folder, so running a migration again repeats no row. A failing
    table ends the run; the tables after it stay pending. With a ``ledger`` path the run
    leaves its events there, also while a staged table is loaded.
    """

    def __init__(
        self, spark: SparkSession, run_id: str, target: str, stage: str, ledger: str | None = None
    ):
        self.spark, self.run_id = spark, run_id
        self.target, self.stage = target.rstrip("/"), stage
        self.plans: list[TablePlan] = []
        self.ledger = Ledger(spark, ledger, run_id)

    def add_table(self, plan: TablePlan) -> Migration:
        if plan.name in {p.name for p in self.plans}:
            raise ValueError(f"table {plan.name!r} was already added")
        self.plans.append(plan)
        return self

    def preflight(self) -> dict[str, str]:
        """Errors of plans whose source or shape does not fit, by table; nothing is moved."""
        errors = {}
        for plan in self.plans:
            try:
                plan.shaped(plan.source).schema  # noqa: B018 - analysis is the check
            except Exception as e:  # noqa: BLE001 - the error belongs into the report
                errors[plan.name] = str(e)
        return errors

    def run(self) -> DataFrame:
        """Check all plans, then move the tables; one row per table."""
        plans = sorted(self.plans, key=lambda p: not p.dimension)
        self.ledger.add("started", source_type="spark", target_database=self.target)
        errors = self.preflight()
        if errors:
            self.ledger.add("failed", error="; ".join(errors.values()))
            self.ledger.flush()
            return self.spark.createDataFrame([
                (p.name, p.strategy, None, None, False, "failed" if p.name in errors else "pending",
                 errors.get(p.name)) for p in plans
            ], RESULT)
        staged = {p.name: self._register(p) for p in plans}
        self.ledger.flush()
        rows, error = [], None
        for plan in plans:
            if error:
                rows.append((plan.name, plan.strategy, None, None, False, "pending", None))
                continue
            try:
                rows.append(self._move(plan, staged[plan.name]))
                error = rows[-1][6]
            except Exception as e:  # noqa: BLE001 - the error belongs into the report
                error = str(e)
                rows.append((plan.name, plan.strategy, None, None, False, "failed", error))
            self.ledger.flush()
        matched = sum(r[4] for r in rows)
        self.ledger.add("validation_done", rows=matched, total_rows=len(rows))
        self.ledger.add("failed" if error else "done", error=error)
        self.ledger.flush()
        return self.spark.createDataFrame(rows, RESULT)

    def _register(self, plan: TablePlan) -> bool:
        """Announce a table with its strategy; returns whether it is staged.

        Only a table whose strategy is left open is counted, since the copy counts the rows
        anyway. A count that fails is only a warning here: the copy will tell.
        """
        total = None
        if plan.strategy == "auto":
            try:
                total = plan.source.count()
            except Exception as e:  # noqa: BLE001
                self.ledger.add("log", table=plan.name, error=f"row count failed: {e}")
        staged = plan.strategy == "staged" or (total or 0) > fv.STAGE_ROWS_THRESHOLD
        self.ledger.add(
            "table_registered", table=plan.name, total_rows=total, strategy=_named(staged)
        )
        return staged

    def _move(self, plan: TablePlan, staged: bool) -> tuple:
        start = time.monotonic()
        source_rows, total_bytes = (self._staged_copy if staged else self._direct_copy)(plan)
        target_rows = self.spark.read.parquet(self._path(plan)).count()
        matched = source_rows == target_rows
        done = {
            "table": plan.name, "total_rows": target_rows, "rows": target_rows,
            "strategy": _named(staged), "total_bytes": total_bytes,
            "seconds": round(time.monotonic() - start, 3),
        }
        if not staged:
            self.ledger.add("batch_done", **done)
        if matched:
            self.ledger.add("table_done", **done)
        return (
            plan.name, "staged" if staged else "direct", source_rows, target_rows, matched,
            "done" if matched else "failed",
            None if matched else f"{source_rows} source rows, {target_rows} target rows",
        )

    def _path(self, plan: TablePlan) -> str:
        return f"{self.target}/{plan.name}"

    def _direct_copy(self, plan: TablePlan) -> tuple[int, None]:
        """Source rows are counted while they are written."""
        seen = Observation()
        source = plan.source.observe(seen, F.count(F.lit(1)).alias("rows"))
        plan.shaped(source).write.mode("overwrite").parquet(self._path(plan))
        return seen.get["rows"], None

    def _staged_copy(self, plan: TablePlan) -> tuple[int, int]:
        def phase(name: str, **more) -> None:
            self.ledger.add("phase_started", table=plan.name, phase=name, **more)

        phase("unloading")
        seen = Observation()
        source = plan.source.observe(seen, F.count(F.lit(1)).alias("rows"))
        # An estimate is enough to cut a small table into some files; a large one has many anyway.
        rows = estimated_bytes(plan.source) // max(1, plan.source._jdf.schema().defaultSize())
        per_file = max(1, min(rows // (4 * LEAST_STEPS), 2**31 - 1))
        stats = stage_export(source, self.stage, self.run_id, plan.name, rows_per_file=per_file).first()
        size = {"total_bytes": stats["total_bytes"], "total_rows": seen.get["rows"]}
        phase("staged", file_count=stats["file_count"], **size)
        phase("loading", **size)

        def progress(rows: int, done: int) -> None:
            self.ledger.add("bytes_progress", table=plan.name, bytes_done=done, rows=rows, **size)
            self.ledger.flush()

        progress(0, 0)
        stream_load(
            self.spark, stage_path(self.stage, self.run_id, plan.name), self._path(plan),
            plan.shaped, stats["file_count"], stats["total_bytes"], progress,
        )
        phase("validating")
        return seen.get["rows"], stats["total_bytes"]


def _named(staged: bool) -> str:
    return "s3_stage" if staged else "direct"


def resume_plan(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Per table: skip a complete copy, reload a partial one, load an empty one."""
    joined = expected.select("table_name", F.col("rows").alias("expected_rows")).join(
        actual.select("table_name", F.col("rows").alias("actual_rows")), "table_name", "full"
    )
    there = F.coalesce("actual_rows", F.lit(0))
    action = (
        F.when(F.col("expected_rows").isNull(), "unknown table")
        .when(there == F.col("expected_rows"), "skip")
        .when(there == 0, "load").otherwise("truncate and reload")
    )
    return joined.withColumn("action", action)
