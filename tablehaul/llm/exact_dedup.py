"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

1. Every document becomes its id and a SHA-256 digest of its text.
2. Misra-Gries summaries find the digests that may be frequent: Spark's ``approx_top_k`` keeps
   a bounded table of counters that are all lowered when it is full (by their median rather
   than by one) and that merges. Digests are dealt to ``SHARDS`` groups by hash and each group
   has a summary of ``TRACKED`` counters, so summaries merge in parallel, and a digest with
   more than about ``8 / TRACKED`` of its group's rows is found.
3. An exact count over the candidates verifies them and elects the winner of each. At most
   ``SHARDS * TOP`` winners of about 100 bytes exist, whatever the input, so they are
   broadcast and decide their rows on the map side.
4. All other digests go through an ordinary aggregation and join. None of them is frequent.

Missing a frequent digest would only cost speed: the ordinary path is exact too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import same, text_of, unused
from tablehaul.session import saved

SHARDS = 64
TRACKED = 256
TOP = 64


def digests(docs: DataFrame, id_col: Column, text_col: str = "text") -> DataFrame:
    """``id`` and 32-byte ``digest`` of each document."""
    return docs.select(id_col.alias("id"), F.unhex(F.sha2(text_of(text_col), 256)).alias("digest"))


def frequent(keyed: DataFrame) -> DataFrame:
    """64-bit hashes of the digests that the Misra-Gries summaries hold as most frequent."""
    item = F.xxhash64("digest")
    top = F.expr(f"approx_top_k(item, {TOP}, {TRACKED})")
    return (
        keyed.select(item.alias("item"))
        .groupBy(F.pmod("item", F.lit(SHARDS)).alias("shard")).agg(top.alias("top"))
        .select(F.explode("top").alias("top"))
        .filter(F.col("top.count") > 1)
        .select(F.col("top.item").alias("item"))
    )


def _elected(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("digest").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )


def exact_groups(keyed: DataFrame) -> DataFrame:
    """One row per row of ``keyed`` (``id, digest``): ``id, digest, keep_id, group_size``.

    Texts are equal when identical; NULL counts as empty. The largest id of a group stays.
    NULL ids rank below all others, and a group that has nothing else keeps NULL. Repeated
    rows are rows of their group. An empty table gives no rows. ``keyed`` is read several
    times, so it should be a written table.
    """
    candidates = F.broadcast(frequent(keyed))  # at most SHARDS * TOP longs
    suspects = keyed.join(candidates, F.xxhash64("digest") == F.col("item"), "left_semi")
    winners = saved(_elected(suspects).filter(F.col("group_size") > 1), "winners")
    heavy = keyed.join(F.broadcast(winners), "digest")  # at most SHARDS * TOP rows
    rest = keyed.join(F.broadcast(winners), "digest", "left_anti")
    light = rest.join(_elected(rest), "digest")
    return heavy.unionByName(light)


def document_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``exact_groups`` of a table of documents."""
    return exact_groups(saved(digests(docs, F.col(id_col), text_col), "digests"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one row of each group of equal texts, in all their columns.

    The row with the largest id stays; of repeated rows with that id one.
    """
    row = unused(docs, "row_number")
    marked = saved(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    number = F.struct(F.col(id_col).alias("id"), F.col(row).alias("row"))
    groups = exact_groups(saved(digests(marked, number, text_col), "digests"))
    stays = groups.filter(same(F.col("id"), F.col("keep_id"))).select(F.col("id.row").alias(row))
    return marked.join(stays, row).select(*docs.columns)
