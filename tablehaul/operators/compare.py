"""Benchmark runs and what follows from their timings.

The engine's time is what Spark itself reports of a query's execution: its planning phases and
the run of the plan. The wall time is what the caller sees, with the building of the DataFrame
around it.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.java_gateway import ensure_callback_server_started
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablehaul import fixed_values as fv

RESULT = (
    "query_n bigint, name string, source_ms double, source_wall_ms double, source_planning_ms double, "
    "target_ms double, target_wall_ms double, target_planning_ms double, source_rows bigint, "
    "target_rows bigint, source_error string, target_error string"
)
#: Seconds to wait for Spark's report of an execution that has ended.
PATIENCE = 30.0


@dataclass
class Timing:
    """What is known of one side; a failed side has its error and no times."""

    engine_ms: float | None = None
    wall_ms: float | None = None
    planning_ms: float | None = None
    rows: int | None = None
    error: str | None = None


class Executions:
    """Spark's reports of executed queries, told apart by the name of their observation."""

    def __init__(self, spark: SparkSession):
        self.manager = spark._jsparkSession.listenerManager()
        self.told: dict[str, tuple[float, float]] = {}
        self.changed = threading.Condition()
        ensure_callback_server_started(spark.sparkContext._gateway)

    def __enter__(self) -> Executions:
        self.manager.register(self)
        return self

    def __exit__(self, *failure) -> None:
        self.manager.unregister(self)

    def onSuccess(self, name, execution, nanoseconds) -> None:  # noqa: N802 - Spark's name
        phases = execution.tracker().phases()
        planning, each = 0.0, phases.valuesIterator()
        while each.hasNext():
            planning += each.next().durationMs()
        seen = execution.observedMetrics().keysIterator()
        with self.changed:
            while seen.hasNext():
                self.told[seen.next()] = nanoseconds / 1e6, planning
            self.changed.notify_all()

    def onFailure(self, name, execution, error) -> None:  # noqa: N802 - Spark's name
        pass

    def of(self, name: str) -> tuple[float | None, float | None]:
        """Milliseconds of an execution and of its planning; unknown ones are NULL."""
        with self.changed:
            self.changed.wait_for(lambda: name in self.told, PATIENCE)
            return self.told.pop(name, (None, None))

    class Java:
        implements = ["org.apache.spark.sql.util.QueryExecutionListener"]


def time_query(build: Callable[[], DataFrame] | None, executions: Executions) -> Timing:
    """Times, rows and error of one query; its rows are computed and discarded."""
    if build is None:
        return Timing()
    try:
        name = f"bench-{uuid.uuid4().hex}"
        seen = Observation(name)
        start = time.perf_counter()
        build().observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode(
            "overwrite"
        ).save()
        wall = (time.perf_counter() - start) * 1000
        engine, planning = executions.of(name)
        return Timing(engine, wall, planning, seen.get["rows"])
    except Exception as e:  # noqa: BLE001 - the error belongs into the report
        return Timing(error=str(e))


def bench_run(
    spark: SparkSession,
    pairs: list[tuple[str, Callable[[], DataFrame] | None, Callable[[], DataFrame] | None]],
) -> DataFrame:
    """Time pairs of equivalent queries; a failing side leaves its error and no time.

    ``source_ms`` and ``target_ms`` are the engine's times, by which sides are compared; the wall
    times are never shorter, and the planning phases are part of them.
    """
    rows = []
    with Executions(spark) as executions:
        for n, (name, source, target) in enumerate(pairs):
            s, t = time_query(source, executions), time_query(target, executions)
            rows.append((
                n, name, s.engine_ms, s.wall_ms, s.planning_ms, t.engine_ms, t.wall_ms, t.planning_ms,
                s.rows, t.rows, s.error, t.error,
            ))
    return spark.createDataFrame(rows, RESULT)


def with_speedup(rows: DataFrame) -> DataFrame:
    """How many times faster the target was; NULL without both times or at zero."""
    ratio = F.when(F.col("target_ms") > 0, F.col("source_ms") / F.col("target_ms"))
    return rows.withColumn("speedup", ratio)


def bench_summary(rows: DataFrame, by: list[str]) -> DataFrame:
    clean = F.col("source_error").isNull() & F.col("target_error").isNull()
    return with_speedup(rows).groupBy(*by).agg(
        F.count(F.lit(1)).alias("queries"), F.count_if(clean).alias("completed"),
        F.avg("speedup").alias("avg_speedup"),
    )


def wall_overhead(rows: DataFrame, threshold: int, side: str) -> DataFrame:
    """Time around the engine's own time, where it is large enough to mention."""
    extra = F.col(f"{side}_wall_ms") - F.col(f"{side}_ms")
    return rows.withColumn(f"{side}_overhead_ms", F.when(extra >= threshold, extra))


def slow_flags(rows: DataFrame, weak: float = fv.WEAK_SPEEDUP) -> DataFrame:
    """Queries to optimise: the target is slower, or not clearly faster."""
    flag = (
        F.when(F.col("speedup") < 1, "target slower").when(F.col("speedup") < weak, "weak speedup")
    )
    return with_speedup(rows).withColumn("flag", flag).filter("flag IS NOT NULL")


def rows_match(rows: DataFrame) -> DataFrame:
    """Both sides returned a row count, and the same one."""
    same = F.col("source_rows") == F.col("target_rows")
    return rows.withColumn("rows_match", F.coalesce(same, F.lit(False)))
