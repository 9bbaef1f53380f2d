"""SimHash near-duplicate groups by covering locality-sensitive hashing.

A covering family for radius r gives each of the 64 bit positions a non-zero code of r + 1
bits; table ``t`` keeps the positions whose code has an odd inner product with ``t``. For any
r positions some ``t`` is orthogonal to all their codes, so two fingerprints that differ in
at most r positions agree on every bit of at least one of the ``2^(r+1) - 1`` masks.

A bucket holds fingerprints that agree on a mask. Up to ``BUCKET`` members are compared
directly. A larger bucket is dealt again by a covering family over the bits its mask leaves
free, which keeps the guarantee; after ``LEVELS`` steps at most 2^free members are left (64
for radius 2), so no bucket is ever compared beyond a fixed size, and none is cut off.
Exact copies meet as one fingerprint before that.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import unused
from tablehaul.llm.components import connected_components
from tablehaul.session import saved

SHINGLE = 3
RADIUS = 2
BITS = 64
BUCKET = 16
LEVELS = 3
SEED = 42
#: Shingles whose bits are added up at once.
CHUNK = 65_536


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint: bit i is set when it is set in more than half the shingles' hashes.

    Words are runs without ASCII white space, A-Z in lower case. A text of fewer words than a
    shingle is one shingle; NULL and texts without words give 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()[shingle - 1:] or [len(joined)]
    spans = list(zip(starts, ends))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(spans), CHUNK):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in spans[at:at + CHUNK]], dtype="<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(spans), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed 64-bit number."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return prints(text)


def covering_masks(radius: int, positions: list[int]) -> list[int]:
    """Masks over the given bit positions; any ``radius`` of them are all absent from one."""
    tables = 2 ** (radius + 1) - 1
    return [
        sum(1 << p for i, p in enumerate(positions) if ((i % tables + 1) & t).bit_count() % 2)
        for t in range(1, tables + 1)
    ]


def mask_levels(radius: int, levels: int = LEVELS) -> list[list[tuple[int, int, int]]]:
    """For each level (parent table, table, mask); a mask holds its parent's bits too."""
    result, parents = [], [(0, 0)]
    for _ in range(levels):
        rows = []
        for parent, fixed in parents:
            free = [p for p in range(BITS) if not fixed >> p & 1]
            for mask in covering_masks(radius, free):
                rows.append((parent, len(rows), fixed | mask))
        result.append(rows)
        parents = [(table, mask) for _, table, mask in rows]
    return result


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def near_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``u < v`` of distinct values in column ``fp`` that differ in at most ``radius`` bits."""
    spark = prints.sparkSession
    dealt, pairs = prints.select("fp"), None
    levels = mask_levels(radius)
    for depth, rows in enumerate(levels, 1):
        if depth == 1:
            masks = [F.struct(F.lit(t).alias("tab"), F.lit(_signed(m)).alias("mask")) for _, t, m in rows]
            tables = dealt.select("fp", F.explode(F.array(*masks)).alias("m")).select("fp", "m.*")
        else:
            masks = spark.createDataFrame(
                [(p, t, _signed(m)) for p, t, m in rows], "parent int, tab int, mask long"
            )  # 49 and 343 rows for radius 2, 7 of them for each parent
            tables = dealt.join(F.broadcast(masks), "parent")
        tables = tables.select("fp", "tab", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        sizes = tables.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        members = saved(tables.join(saved(sizes, "bucket-sizes"), ["tab", "key"]), "buckets")
        last = depth == len(levels)
        direct = members if last else members.filter(F.col("n") <= BUCKET)
        a = direct.select("tab", "key", F.col("fp").alias("u"))
        b = direct.select("tab", "key", F.col("fp").alias("v"))
        close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius
        found = a.join(b, ["tab", "key"]).filter((F.col("u") < F.col("v")) & close)
        found = found.select("u", "v")
        pairs = found if pairs is None else pairs.unionByName(found)
        dealt = members.filter(F.col("n") > BUCKET).select("fp", F.col("tab").alias("parent"))
        if last or dealt.isEmpty():
            break
    return pairs.distinct()


def near_groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, root, least_id`` of every distinct fingerprint in ``prints`` (``id, fp``).

    Fingerprints form a group when links of at most ``radius`` bits connect them. ``root`` is
    the group's least fingerprint and ``least_id`` its smallest id (NULL only if all are).
    """
    distinct = saved(prints.groupBy("fp").agg(F.min("id").alias("id")), "fingerprints")
    labels = connected_components(near_pairs(distinct, radius))
    rooted = saved(
        distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "id", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )
    least = saved(rooted.groupBy("root").agg(F.min("id").alias("least_id")), "least-ids")
    return saved(rooted.join(least, "root").select("fp", "root", "least_id"), "near-groups")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS,
) -> DataFrame:
    """One row per document: ``id, fp, root, least_id``.

    NULL and empty texts have fingerprint 0 and are linked like any other. Repeated rows and
    equal fingerprints share a group; NULL ids belong to groups but never name one that has
    another id. An empty table gives no rows.
    """
    prints = saved(
        docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")),
        "prints",
    )
    return prints.join(near_groups(prints, radius), "fp")


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS,
) -> DataFrame:
    """The documents with one row of each group, the one with the smallest id, in all columns.

    NULL ids rank last; of repeated rows with the smallest id one stays.
    """
    fp, row = unused(docs, "simhash"), unused(docs, "row_number")
    marked = saved(
        docs.withColumn(fp, fingerprint(F.col(text_col), shingle))
        .withColumn(row, F.monotonically_increasing_id()),
        "marked",
    )
    number = F.struct(
        F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(row).alias("row")
    )
    prints = marked.select(number.alias("id"), F.col(fp).alias("fp"))
    least = near_groups(prints, radius).filter(F.col("fp") == F.col("root"))
    return marked.join(least.select(F.col("least_id.row").alias(row)), row).select(*docs.columns)
