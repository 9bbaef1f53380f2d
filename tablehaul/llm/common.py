"""What the corpus operators share: reading tables, free column names, batch sizes."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.session import prepare

#: Rows and bytes of one Arrow batch, whichever is reached first: texts of some kilobytes make
#: a few megabytes, and many very long ones together stay within the bytes.
BATCH_ROWS = 2_000
BATCH_BYTES = 32 * 1024 * 1024


def ready(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: UTC, AQE, small Arrow batches."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one given table; columns beyond these never reach an operator."""
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores in front when the table has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(column: str = "text") -> Column:
    """A text column in which NULL counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def same(left: Column, right: Column) -> Column:
    """Equality under which NULL equals NULL."""
    return left.eqNullSafe(right)


_model: list = [None, None]


def worker_model(key: tuple, build: Callable[[], Any]) -> Any:
    """What a Python worker has built for ``key``. A worker keeps one such model at a time, so
    the operators of a pipeline do not add up in its memory."""
    if _model[0] != key:
        _model[:] = [None, None]
        _model[:] = [key, build()]
    return _model[1]
