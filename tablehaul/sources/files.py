"""File and query sources, staging, and table folders."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tablehaul.operators.conform import append_columns

TRAILING = "_after_last_delimiter"
REASON = "_reject_reason"


def scan_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Rows of a query; ``{name}`` in the text stands for a given table."""
    return spark.sql(sql, **tables)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def scan_delimited(
    spark: SparkSession, path: str, schema: StructType, quote: str = '"', sep: str = "|",
    encoding: str = "ISO-8859-1",
) -> tuple[DataFrame, DataFrame]:
    """Headerless delimited text as (rows, rejects).

    Lines may end with a delimiter. Rejects are the lines that do not fit: ``file, line, reason``,
    for lines with another number of fields, a quote that is not closed, or a value that its
    column's type cannot hold. Every line is in exactly one of both. ``quote=""`` takes quotes as
    ordinary characters. Empty fields are NULL, and empty lines are skipped.
    """
    return _told_lines(spark, path, schema, quote, sep, encoding)[1:]


def _told_lines(
    spark: SparkSession, path: str, schema: StructType, quote: str, sep: str = "|",
    encoding: str = "ISO-8859-1",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All lines with the reason against them, the rows, and the rejects."""
    names = schema.names
    line, file, behind, bare, values, wrong = (
        _unused(names, n) for n in ("_line", "_file", "_behind", "_bare", "_values", "_wrong")
    )
    options = {
        "sep": sep, "quote": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": line,
    }
    corrupt = StructField(line, StringType())
    # What stands behind the last delimiter is no truth value, so anything there is corrupt.
    padded = StructType([*schema.fields, StructField(TRAILING, BooleanType()), corrupt])
    read = (
        spark.read.options(**options).csv(path, schema=padded, encoding=encoding)
        .withColumn(file, F.col("_metadata.file_path"))
    )
    # Lines that Spark calls corrupt are looked at once more, as texts: with a field behind the
    # last delimiter, which has to be empty, or without one.
    texts = [StructField(n, StringType()) for n in names]

    def again(*fields: StructField) -> Column:
        return F.from_csv(line, StructType([*texts, *fields, corrupt]).toDDL(), options)

    told = read.withColumns({behind: again(StructField(TRAILING, StringType())), bare: again()})
    ended = F.col(behind)[line].isNull() & F.col(behind)[TRAILING].isNull()
    told = told.withColumn(values, F.when(F.col(line).isNull(), None).otherwise(
        F.when(ended, F.struct(*[F.col(behind)[n] for n in names]))
        .when(F.col(bare)[line].isNull(), F.struct(*[F.col(bare)[n] for n in names]))
    ))
    told = told.withColumn(wrong, F.array_compact(F.array(*[
        F.when(
            F.col(values)[n].isNotNull() & F.col(n).isNull(),
            F.format_string(f"{n}: '%s' is no {f.dataType.simpleString()}", F.col(values)[n]),
        )
        for n, f in zip(names, schema.fields)
    ])))
    parts = F.size(F.split(line, re.escape(sep)))
    parts = F.when(F.endswith(F.col(line), F.lit(sep)), parts - 1).otherwise(parts)
    open_quote = F.lit(False)
    if quote:
        quotes = F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))
        open_quote = F.pmod(quotes, F.lit(2)) == 1
    told = told.withColumn(REASON, F.when(
        F.col(line).isNull(),
        F.when(F.col(TRAILING).isNotNull(), F.lit(f"{len(names) + 1} fields instead of {len(names)}")),
    ).when(open_quote, "a quote is not closed").when(
        F.col(values).isNull(), F.format_string(f"%d fields instead of {len(names)}", parts)
    ).when(F.size(wrong) > 0, F.array_join(wrong, "; ")))
    shown = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in (*names, TRAILING)]
    rejects = told.filter(F.col(REASON).isNotNull()).select(
        F.col(file).alias("file"), F.coalesce(line, F.concat_ws(sep, *shown)).alias("line"),
        F.col(REASON).alias("reason"),
    )
    return told, told.filter(F.col(REASON).isNull()).select(*names), rejects


def _unused(names: list[str], name: str) -> str:
    taken = {n.lower() for n in names}
    while name in taken:
        name = f"_{name}"
    return name


def read_pipe_delimited(
    spark: SparkSession, path: str, schema: StructType, quote: str = '"', rejects: str | None = None,
) -> DataFrame:
    """Headerless ``|``-separated text whose lines may end with a delimiter.

    With a ``rejects`` folder, lines that do not fit are written there as a table of ``file, line,
    reason`` and left out. Without one, a query that reads such a line fails with its reason.
    """
    told, rows, bad = _told_lines(spark, path, schema, quote)
    if rejects is None:
        message = F.concat(F.lit("bad line: "), F.col(REASON))
        fits = F.when(F.col(REASON).isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
        return told.filter(fits).select(*schema.names)
    bad.write.mode("overwrite").parquet(rejects)
    return rows


def write_pipe_delimited(df: DataFrame, path: str) -> None:
    (
        df.withColumn(TRAILING, F.lit(None).cast("string"))
        .write.mode("overwrite").csv(path, sep="|", encoding="ISO-8859-1", nullValue="")
    )


def file_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path and size of every file below a folder; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        .load(path).select("path", F.col("length").alias("bytes"))
    )


def stage_path(stage: str, run_id: str, table: str) -> str:
    return f"{stage.rstrip('/')}/{run_id}/{table}"


def stage_export(
    df: DataFrame, stage: str, run_id: str, table: str, file_format: str = "parquet",
    rows_per_file: int = 0,
) -> DataFrame:
    """Write a table to its stage folder, replacing an earlier try; returns files and bytes."""
    path = stage_path(stage, run_id, table)
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if file_format == "parquet":
        writer.option("compression", "snappy").parquet(path)
    else:
        writer.option("header", "true").format(file_format).save(path)
    return file_listing(df.sparkSession, path, f"*.{file_format}").agg(
        F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("file_count"),
        F.sum("bytes").alias("total_bytes"),
    )


def append_conformed(df: DataFrame, target: str) -> None:
    """Append to a Parquet table by column name, in the target's column order and types."""
    schema = df.sparkSession.read.parquet(target).schema
    append_columns(df, schema).write.mode("append").parquet(target)


LOAD = "load_id"


def stage_load(
    spark: SparkSession, staged: str, target: str, file_format: str = "parquet",
    load_id: str | None = None,
) -> DataFrame:
    """Load staged files into a target; what was loaded is the growth of the target.

    With a ``load_id`` the rows go to a folder of that load inside the target, and a load that
    is tried again replaces its first try. Without one they are appended.
    """
    schema = spark.read.parquet(target).schema
    before = spark.read.parquet(target)
    if LOAD in before.columns and load_id is not None:
        before = before.filter(~F.col(LOAD).eqNullSafe(load_id))
    baseline = before.count()
    files = spark.read.format(file_format).option("header", "true").load(staged)
    if load_id is None:
        append_conformed(files, target)
    else:
        own = StructType([f for f in schema.fields if f.name != LOAD])
        append_columns(files, own).write.mode("overwrite").parquet(f"{target}/{LOAD}={load_id}")
    after = spark.read.parquet(target)
    return after.agg(F.count(F.lit(1)).alias("rows_after")).select(
        F.lit(baseline).cast("long").alias("rows_before"),
        (F.col("rows_after") - baseline).alias("rows_done"), "rows_after",
    )


def table_inventory(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows, bytes and columns of every table, largest first."""
    parts = []
    for name, path in paths.items():
        df, this = spark.read.parquet(path), F.lit(name).alias("table_name")
        parts.append(df.agg(
            this, F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns")
        ))
        parts.append(file_listing(spark, path, "*.parquet").agg(this, F.sum("bytes").alias("bytes")))
    facts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return facts.groupBy("table_name").agg(
        *[F.max(c).alias(c) for c in ("rows", "columns", "bytes")]
    ).orderBy(F.desc("bytes"), "table_name")
