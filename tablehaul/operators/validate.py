"""Source and target comparison: counts, sums, ranges, NULLs, rows."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul import fixed_values as fv
from tablehaul.functions.scalars import hashable_columns

Opener = Callable[[], DataFrame]


@dataclass(frozen=True)
class TableCheck:
    """One table on both sides, and the columns its checks look at."""

    name: str
    source: Opener
    target: Opener
    sum_column: str | None = None
    time_column: str | None = None
    required: list[str] = field(default_factory=list)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def union_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table in one job."""
    return _union([
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name, df in tables.items()
    ])


def _facts(df: DataFrame, check: TableCheck) -> DataFrame:
    """Everything the checks need to know about one side, from one scan."""
    nothing = F.lit(None)
    total = F.sum(check.sum_column) if check.sum_column else nothing
    first = F.min(check.time_column) if check.time_column else nothing
    last = F.max(check.time_column) if check.time_column else nothing
    nulls = [F.count_if(F.col(c).isNull()) for c in check.required]
    return df.agg(
        F.lit(check.name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
        total.cast("decimal(38,4)").alias("total"),
        first.cast("timestamp_ntz").alias("first"), last.cast("timestamp_ntz").alias("last"),
        (reduce(Column.__add__, nulls) if nulls else F.lit(0)).cast("long").alias("nulls"),
        F.lit(None).cast("string").alias("error"),
    )


FACTS = (
    "table_name string, rows long, total decimal(38,4), first timestamp_ntz, last timestamp_ntz, "
    "nulls long, error string"
)
#: Tables whose facts are read at the same time when not all can be read together.
AT_ONCE = 4


def _reason(error: Exception) -> str:
    if isinstance(error, PySparkException):
        return error.getCondition() or type(error).__name__
    java = error.java_exception
    reason = java.getCondition() if hasattr(java, "getCondition") else None
    return reason or java.getClass().getSimpleName()


def _both_sides(spark: SparkSession, checks: list[TableCheck]) -> DataFrame:
    """Facts of all tables and sides, one row each, from one job.

    A table that cannot be opened becomes an error row at once. When the job fails, each table and
    side is read by a job of its own, so that only what is damaged becomes an error row.
    """
    opened, rows = [], []

    def failed(check: TableCheck, which: str, error: Exception) -> tuple:
        return which, check.name, None, None, None, None, None, f"{which}: {_reason(error)}"

    for check in checks:
        for which in ("source", "target"):
            try:
                own = _facts(getattr(check, which)(), check).select(F.lit(which).alias("side"), "*")
                opened.append((check, which, own))
            except (PySparkException, Py4JJavaError) as e:
                rows.append(failed(check, which, e))

    def alone(part: tuple) -> tuple:
        check, which, own = part
        try:
            return tuple(own.first())
        except (PySparkException, Py4JJavaError) as e:  # failures of tasks
            return failed(check, which, e)

    if opened:
        try:
            rows += map(tuple, _union([own for _, _, own in opened]).collect())
        except (PySparkException, Py4JJavaError):
            with ThreadPoolExecutor(AT_ONCE) as pool:
                rows += pool.map(alone, opened)
    return spark.createDataFrame(rows, f"side string, {FACTS}")


def compare_tables(
    spark: SparkSession, checks: list[TableCheck], done: DataFrame | None = None
) -> DataFrame:
    """Facts of both sides next to each other, one row per table.

    ``done`` (column ``table_name``) keeps the comparison to tables that finished loading; the
    others are not read.
    """
    if done is not None:
        names = {r["table_name"] for r in done.select("table_name").distinct().collect()}
        checks = [c for c in checks if c.name in names]
    facts = ("rows", "total", "first", "last", "nulls", "error")
    found = _both_sides(spark, checks)
    return found.groupBy("table_name").agg(*[
        F.max(F.when(F.col("side") == which, F.col(c))).alias(f"{which}_{c}")
        for which in ("source", "target") for c in facts
    ])


def row_count_parity(facts: DataFrame) -> DataFrame:
    error = F.concat_ws(" | ", "source_error", "target_error")
    matched = F.coalesce(
        (error == "") & (F.col("source_rows") == F.col("target_rows")), F.lit(False)
    )
    return facts.select(
        "table_name", "source_rows", "target_rows", matched.alias("matched"),
        F.nullif(error, F.lit("")).alias("error"),
    )


def validation_summary(parity: DataFrame) -> DataFrame:
    failed = F.col("error").isNotNull()
    return parity.agg(
        F.count_if(F.col("matched") & ~failed).alias("matched"),
        F.count_if(~F.col("matched") & ~failed).alias("mismatched"),
        F.count_if(failed).alias("errored"), F.count(F.lit(1)).alias("total"),
    )


def _sum_matches() -> Column:
    s, t = F.col("source_total"), F.col("target_total")
    tolerance = F.lit(str(fv.SUM_TOLERANCE)).cast("decimal(5,4)")
    return s.eqNullSafe(t) | F.coalesce(F.abs(s - t) <= F.abs(s) * tolerance, F.lit(False))


def _range_matches() -> Column:
    return F.col("source_first").eqNullSafe(F.col("target_first")) & F.col(
        "source_last"
    ).eqNullSafe(F.col("target_last"))


def sum_parity(facts: DataFrame) -> DataFrame:
    """Sums agree within the tolerance."""
    return facts.select(
        "table_name", F.col("source_total").cast("double").alias("source_sum"),
        F.col("target_total").cast("double").alias("target_sum"), _sum_matches().alias("matched"),
    )


def range_parity(facts: DataFrame) -> DataFrame:
    return facts.select(
        "table_name", "source_first", "source_last", "target_first", "target_last",
        _range_matches().alias("matched"),
    )


def null_parity(facts: DataFrame) -> DataFrame:
    """Required columns hold no NULL on the target."""
    return facts.select(
        "table_name", "source_nulls", "target_nulls",
        (F.col("target_nulls") == 0).alias("matched"),
    )


def validation_report(facts: DataFrame) -> DataFrame:
    """All four checks, one row per table."""
    rows_match = F.col("source_rows").eqNullSafe(F.col("target_rows"))
    return facts.select(
        "table_name", "source_rows", "target_rows", rows_match.alias("rows_match"),
        _sum_matches().alias("sum_match"), _range_matches().alias("range_match"),
        "target_nulls",
    )


def expected_rows_check(counts: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Actual counts against declared ones; a table nobody loaded has no actual count."""
    pairs = F.explode(F.map_from_arrays(
        F.array(*[F.lit(k) for k in expected]),
        F.array(*[F.lit(v).cast("long") for v in expected.values()]),
    ))
    declared = counts.sparkSession.range(1).select(pairs.alias("table_name", "expected_rows"))
    return declared.join(counts, "table_name", "left").select(
        "table_name", "expected_rows", F.col("rows").alias("actual_rows"),
        F.col("expected_rows").eqNullSafe(F.col("rows")).alias("matched"),
    )


def result_compare(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows one result has more often than the other, with the surplus; empty when equal."""
    columns = source.columns
    both = source.withColumn("_n", F.lit(1)).unionByName(target.withColumn("_n", F.lit(-1)))
    surplus = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return surplus.select(
        F.when(F.col("_n") > 0, "source").otherwise("target").alias("only_in"),
        F.abs("_n").alias("surplus"), *columns,
    )


def result_compare_tolerant(
    source: DataFrame, target: DataFrame, keys: list[str], tolerance: dict[str, float]
) -> DataFrame:
    """Keys whose values differ by more than a relative tolerance, or that one side lacks.

    Both results hold one row per key.
    """
    t = target.withColumn("_there", F.lit(True)).alias("t")
    s = source.withColumn("_here", F.lit(True)).alias("s")
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}"))
    joined = s.join(t, condition, "full")
    close = F.lit(True)
    for c, limit in tolerance.items():
        a, b = F.col(f"s.{c}").cast("double"), F.col(f"t.{c}").cast("double")
        close = close & (
            a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= F.abs(a) * limit, F.lit(False))
        )
    verdict = (
        F.when(F.col("_there").isNull(), "missing").when(F.col("_here").isNull(), "extra")
        .when(~close, "differs")
    )
    return joined.select(
        *[F.coalesce(f"s.{k}", f"t.{k}").alias(k) for k in keys], verdict.alias("difference")
    ).filter("difference IS NOT NULL")


#: Buckets of keys whose digests are compared before any row is sorted by key.
HASH_BUCKETS = 1 << 16
_LOW = 0x1FFFFF


def _row_hash(df: DataFrame, columns: list[str]) -> Column:
    """Hash of a row's values and of which of them are NULL."""
    values = hashable_columns(df.select(*columns))
    nulls = [
        reduce(Column.__add__, [F.when(F.col(c).isNull(), 1 << i).otherwise(0).cast("long") for i, c in enumerate(part)])
        for part in (columns[a:a + 60] for a in range(0, len(columns), 60))
    ]
    return F.xxhash64(*values, *nulls)


def _digest(hashed: str) -> list[Column]:
    """Sums of a hash in three parts of at most 22 bits, which leaves room for 2^41 rows."""
    h = F.col(hashed)
    return [
        F.sum(F.shiftrightunsigned(h, 42)),
        F.sum(F.shiftrightunsigned(h, 21).bitwiseAND(F.lit(_LOW))), F.sum(h.bitwiseAND(F.lit(_LOW))),
    ]


def differing_buckets(
    source: DataFrame, target: DataFrame, keys: list[str], buckets: int = HASH_BUCKETS
) -> list[int]:
    """Buckets of keys whose rows differ in number or digest.

    Both sides are folded to one row per bucket before anything is shuffled; at most ``buckets``
    numbers come to the driver, and none where the sides agree.
    """
    columns = sorted(source.columns)
    bucket = F.pmod(F.xxhash64(*hashable_columns(source.select(*keys))), F.lit(buckets)).cast("int")

    def folded(df: DataFrame, side: str) -> DataFrame:
        return df.select(
            bucket.alias("bucket"), _row_hash(df, columns).alias("_hash"), F.lit(side).alias("side")
        ).groupBy("bucket", "side").agg(F.struct(F.count(F.lit(1)), *_digest("_hash")).alias("digest"))

    both = folded(source, "source").unionByName(folded(target.select(*source.columns), "target"))
    sides = {s: F.max(F.when(F.col("side") == s, F.col("digest"))) for s in ("source", "target")}
    differs = ~sides["source"].eqNullSafe(sides["target"])
    return [r[0] for r in both.groupBy("bucket").agg(differs.alias("d")).filter("d").select("bucket").collect()]


def row_hash_compare(
    source: DataFrame, target: DataFrame, keys: list[str], buckets: int = HASH_BUCKETS
) -> DataFrame:
    """Keys whose rows differ between the two sides.

    Digests of key buckets are compared first, and only rows of buckets that differ are compared
    by key, so two tables that agree are read once and none of their rows is shuffled. The rows of
    a key are folded into a count and sums of hashes before the join, so repeated keys compare as
    multisets and a hot key is one row per side. NULLs are hashed apart from empty values.
    """
    differing = differing_buckets(source, target, keys, buckets)
    if not differing:
        return source.sparkSession.createDataFrame(
            [], source.select(*keys, F.lit("").alias("difference")).schema
        )
    columns = sorted(source.columns)
    wanted = source.sparkSession.createDataFrame([(b,) for b in differing], "_bucket int")

    def folded(df: DataFrame, side: str) -> DataFrame:
        hashed = df.select(*keys, _row_hash(df, columns).alias("_hash"))
        if 2 * len(differing) < buckets:
            own = F.pmod(F.xxhash64(*hashable_columns(df.select(*keys))), F.lit(buckets)).cast("int")
            hashed = hashed.withColumn("_bucket", own).join(F.broadcast(wanted), "_bucket", "left_semi")
        return hashed.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(f"{side}_rows"), F.struct(*_digest("_hash")).alias(f"{side}_hash")
        )

    # The target's keys get names of their own: both sides may come from one table.
    s, t = folded(source, "source"), folded(target, "target")
    t = t.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    joined = s.join(t, same, "full")
    verdict = (
        F.when(F.col("target_rows").isNull(), "missing")
        .when(F.col("source_rows").isNull(), "extra")
        .when(
            (F.col("source_rows") != F.col("target_rows"))
            | (F.col("source_hash") != F.col("target_hash")),
            "changed",
        )
    )
    return joined.select(
        *[F.coalesce(k, f"_k_{k}").alias(k) for k in keys], verdict.alias("difference")
    ).filter("difference IS NOT NULL")
