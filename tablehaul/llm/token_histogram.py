"""Exact token counts for every context limit, from a histogram of encoded lengths.

Documents are encoded whole and counted by length. Everything else reads the histogram, whose
size depends on the longest document, not on the number of documents: running and suffix sums
answer how many documents fit a limit, what they hold, and what is left of all documents when
longer ones are cut. The sums run in two steps, over blocks of lengths and inside each block,
so no task reads the whole histogram.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.llm.tokens import bundles, encoder
from tablehaul.session import saved

#: Neighbouring lengths that are summed in one task.
LENGTHS = 256


def encoded_length(text: Column, tokenizer_file: str) -> Column:
    """Number of tokens of a text without special tokens; NULL and empty texts have 0."""

    @F.pandas_udf("long")
    def lengths(texts: pd.Series) -> pd.Series:
        tokens = encoder(tokenizer_file)
        found: list[int] = []
        for own in bundles(t or "" for t in texts):
            found += [len(ids) // 4 for ids in tokens.packed(own)]
        return pd.Series(found, dtype="int64")

    return lengths(text)


def length_histogram(docs: DataFrame, tokenizer_file: str, text_col: str = "text") -> DataFrame:
    """``tokens, n_docs``: how many documents have each encoded length.

    Repeated rows count as often as they occur; an empty table gives an empty histogram.
    """
    lengths = docs.select(encoded_length(F.col(text_col), tokenizer_file).alias("tokens"))
    return saved(lengths.groupBy("tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")


def with_limits(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """The histogram with a row of no documents for each of the limits that is not a length."""
    asked = F.explode(F.array(*[F.lit(n).cast("long") for n in limits])).alias("tokens")
    spark = histogram.sparkSession
    more = spark.range(1).select(asked, F.lit(0).cast("long").alias("n_docs"))
    return histogram.unionByName(more).groupBy("tokens").agg(F.sum("n_docs").alias("n_docs"))


def limit_totals(histogram: DataFrame) -> DataFrame:
    """One row per length of the histogram, taken as a context limit, with exact totals.

    ``docs_within`` and ``tokens_within`` count documents of at most that length, ``docs_over``
    and ``tokens_over`` the longer ones, and ``truncated_tokens`` is what remains of all
    documents when longer ones are cut at the limit. Between two lengths only the last one
    changes, by ``docs_over`` for each token.
    """
    marked = histogram.withColumns({
        "block": F.floor(F.col("tokens") / LENGTHS), "held": F.col("tokens") * F.col("n_docs"),
    })
    blocks = marked.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("held").alias("t"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    # One row per LENGTHS lengths is all that meets in one task here.
    ends = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d_before"),
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t_before"),
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
    )
    upto = Window.partitionBy("block").orderBy("tokens")
    beyond = upto.rowsBetween(1, Window.unboundedFollowing)
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)

    def over(column: str, window, rest: str) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0)) + F.col(rest)

    summed = marked.join(ends, "block").select(
        F.col("tokens").alias("context_limit"), "n_docs",
        over("n_docs", upto, "d_before").alias("docs_within"),
        over("held", upto, "t_before").alias("tokens_within"),
        over("n_docs", beyond, "d_after").alias("docs_over"),
        over("held", beyond, "t_after").alias("tokens_over"),
    )
    return summed.withColumn(
        "truncated_tokens", F.col("tokens_within") + F.col("context_limit") * F.col("docs_over")
    )


def truncated_total(totals: DataFrame, limit: int) -> DataFrame:
    """One row: tokens that remain of all documents when cut at any ``limit`` of 0 or more."""
    below = F.col("context_limit") <= limit
    step = F.max(F.when(below, F.struct("context_limit", "truncated_tokens", "docs_over")))
    row = totals.agg(step.alias("s"), F.sum("n_docs").alias("n"))
    kept = F.col("s.truncated_tokens") + (limit - F.col("s.context_limit")) * F.col("s.docs_over")
    return row.select(
        F.coalesce(kept, F.col("n") * limit, F.lit(0)).cast("long").alias("truncated_tokens")
    )


def quantiles(totals: DataFrame, points: Sequence[float]) -> DataFrame:
    """``point, tokens``: the least length that at least this share of the documents has or is
    below (a point of 0 gives the shortest). No rows for a histogram without documents."""
    totals = totals.filter(F.col("n_docs") > 0)
    asked = F.explode(F.array(*[F.lit(float(p)) for p in points])).alias("point")
    rows = totals.select(asked, "context_limit", "docs_within", "docs_over")
    reached = F.col("docs_within") >= F.col("point") * (F.col("docs_within") + F.col("docs_over"))
    return rows.filter(reached).groupBy("point").agg(F.min("context_limit").alias("tokens"))
