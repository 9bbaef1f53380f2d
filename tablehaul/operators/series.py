"""Regular time series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gap_fill(
    df: DataFrame, column: str, start: dt.datetime, end: dt.datetime, step: str,
    fill: dict[str, object], inclusive_end: bool = True,
) -> DataFrame:
    """One row per step from ``start`` to ``end``; steps ``df`` lacks get the fill values.

    ``df`` holds one row per step, so the join cannot multiply rows.
    """
    first, last = (F.lit(str(x)).cast("timestamp_ntz") for x in (start, end))
    steps = (
        df.sparkSession.range(1)
        .select(F.explode(F.sequence(first, last, F.expr(f"INTERVAL {step}"))).alias(column))
    )
    if not inclusive_end:
        steps = steps.filter(F.col(column) < last)
    return steps.join(df, column, "left").fillna(fill)
