"""Secret scanning with an incremental blob ledger.

Every historical version of every path is addressed by the SHA-256 of its content. The ledger
is a Parquet table with one row per scanned pair of blob and rule version, which holds the
findings of that pair. A scan reads only pairs that the ledger lacks, appends them, and joins
the findings of the wanted rule versions back to all paths. Rows are complete in themselves:
a failed or repeated scan leaves pairs to scan again or twice, never half-known ones.

Texts of any length are scanned whole, in time linear in their length. A table without rows adds
nothing to the ledger and has no result. Columns beside the two that are named count for nothing,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import same, text_of
from tablehaul.session import saved


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count when group ``group`` has ``least`` characters.

    A new ``version`` makes the ledger scan every blob for this rule again.
    """

    kind: str
    version: int
    pattern: str
    group: int
    least: int


# The kinds in their listed order, their patterns and lengths.
RULES = (
    Rule(
        "assign", 1,
        r"(?i:(password|passwd|secret|token|api_?key))"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)

_SPAN = "array<struct<start:long,end:long>>"
_PAIRS = f"array<struct<kind:string,version:int,spans:{_SPAN}>>"


def find(rule: Rule, text: str) -> list[tuple[int, int]]:
    """Spans of the rule's leftmost, non-overlapping matches in code points; short ones drop."""
    return [
        m.span() for m in re.finditer(rule.pattern, text, re.ASCII)
        if len(m.group(rule.group)) >= rule.least
    ]


def _pair(rule: Rule) -> Column:
    return F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"))


def _scanner(rules: Sequence[Rule]):
    known = {(r.kind, r.version): r for r in rules}

    @F.pandas_udf(_PAIRS)
    def scan(texts: pd.Series, wanted: pd.Series) -> pd.Series:
        out = []
        for text, pairs in zip(texts, wanted):
            out.append([
                {
                    "kind": p["kind"], "version": p["version"],
                    "spans": [
                        {"start": a, "end": b}
                        for a, b in find(known[p["kind"], p["version"]], text)
                    ],
                }
                for p in pairs
            ])
        return pd.Series(out, dtype=object)

    return scan


class BlobLedger:
    """Scanned pairs and their findings under one folder, shared by all executors."""

    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def rows(self) -> DataFrame:
        """``blob, kind, version, spans``; empty before the first scan."""
        schema = f"blob binary, kind string, version int, spans {_SPAN}"
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.folder)

    def scan(
        self, versions: DataFrame, path_col: str, text_col: str, rules: Sequence[Rule] = RULES
    ) -> DataFrame:
        """Scan what is new in ``versions`` and return ``path, blob, kinds`` for every row.

        ``kinds`` is an array of (kind, version, spans), empty where nothing was found. NULL
        texts count as empty, rows with a NULL path keep it, and repeated rows each get their
        result. Equal texts are scanned once (once per repeated row of the first path).
        """
        digest = F.unhex(F.sha2(text_of(text_col), 256))
        paths = saved(
            versions.select(F.col(path_col).alias("path"), digest.alias("blob")), "versions"
        )
        self._scan_unseen(versions, paths, path_col, text_col, digest, rules)
        current = F.struct("kind", "version").isin(*[_pair(r) for r in rules])
        found = (
            self.rows().filter(current & (F.size("spans") > 0))
            .groupBy("blob").agg(F.collect_set(F.struct("kind", "version", "spans")).alias("kinds"))
        )  # at most one entry per rule
        found = saved(found, "findings")
        return paths.join(found, "blob", "left").select(
            "path", "blob", F.coalesce("kinds", F.array().cast(_PAIRS)).alias("kinds")
        )

    def _scan_unseen(self, versions, paths, path_col, text_col, digest, rules) -> None:
        first = paths.groupBy("blob").agg(F.min("path").alias("path"))
        pairs = first.withColumn("pair", F.explode(F.array(*[_pair(r) for r in rules])))
        unseen = (
            pairs.select("blob", "path", "pair.*").join(self.rows().select("blob", "kind", "version"),
                       ["blob", "kind", "version"], "left_anti")
            .groupBy("blob", "path").agg(F.collect_set(F.struct("kind", "version")).alias("wanted"))
            .select(F.col("blob").alias("b"), F.col("path").alias("p"), "wanted")
        )
        content = versions.select(
            digest.alias("blob"), F.col(path_col).alias("path"), text_of(text_col).alias("content")
        )
        scan = _scanner(rules)
        (
            content.join(unseen, (F.col("blob") == F.col("b")) & same(F.col("path"), F.col("p")))
            .select("blob", F.explode(scan("content", "wanted")).alias("pair"))
            .select("blob", "pair.*")
            .write.mode("append").parquet(self.folder)
        )
