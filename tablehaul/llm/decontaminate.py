"""Benchmark decontamination with an FM-index per shard of the training texts.

Test items are cut into windows of ``WINDOW`` consecutive words (a shorter item is one window).
The alphabet is the items' words: a training word that no item has cannot be part of an
occurrence and ends a run, and a run shorter than the shortest window cannot hold one. What is
left of a shard's words is indexed; all windows are searched backwards at once, occurrences
are located through sampled suffix positions, and overlapping ones merge into removal spans.

Items come to the driver and are broadcast in blocks of at most about ``BLOCK_CHARS``
characters. One block is the rule; more blocks mean one pass over the texts for each, and are
dealt out in the shared folder, from where each comes to the driver when its pass begins.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import unused, worker_model
from tablehaul.llm.fm_index import FMIndex
from tablehaul.session import saved, work_path

WINDOW = 10
BLOCK_CHARS = 8_000_000
#: Words of one shard, so that its index stays within some tens of megabytes.
SHARD_WORDS = 400_000

# Words are runs of digits, letters and everything beyond ASCII, A-Z in lower case. In UTF-8
# the bytes of the latter are all 128 or more, so bytes can be classified one by one.
_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")

LEAK = (
    "n_words long, spans array<struct<first_word:long,n_words:long,start:long,end:long>>, "
    "items array<string>"
)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


class Phrases:
    """The windows of a block of items as rows of word numbers, padded in front with 0."""

    def __init__(self, items: tuple[tuple[str, str], ...], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        rows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for at in range(max(1, len(own) - window + 1) if own else 0):
                rows.setdefault(tuple(own[at:at + window]), set()).add(item)
        self.patterns = np.zeros((len(rows), window), np.int64)
        for i, row in enumerate(rows):
            self.patterns[i, window - len(row):] = row
        self.lengths = np.array([len(row) for row in rows], np.int64)
        self.items = list(rows.values())
        self.shortest = int(self.lengths.min()) if rows else 0

    def runs(self, text: str) -> tuple[int, list[int], list[tuple[int, int]]]:
        """Number of words; symbols of all long enough runs, each ended by 0; (first word,
        length) of each run."""
        number = self.vocabulary.get
        codes = [number(w, 0) for w in words(text)]
        if len(codes) < self.shortest:
            return len(codes), [], []
        known = np.concatenate(([0], np.array(codes, np.int64) != 0, [0]))
        change = np.flatnonzero(np.diff(known))
        starts, ends = change[::2].tolist(), change[1::2].tolist()
        symbols, places = [], []
        for a, b in zip(starts, ends):
            if b - a >= self.shortest:
                symbols += codes[a:b]
                symbols.append(0)
                places.append((a, b - a))
        return len(codes), symbols, places

    def search(self, symbols: list[int], owners: list[tuple[int, int, int]]) -> dict:
        """Per text: its merged (first word, end word) spans and the items found in it.

        ``owners`` has (text, first word, length) of each run in ``symbols``.
        """
        index = FMIndex(np.array(symbols, np.int64), len(self.vocabulary))
        which, position = index.occurrences(self.patterns)
        texts, firsts, lengths = (np.array(x, np.int64) for x in zip(*owners))
        run_at = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        run = np.searchsorted(run_at, position, side="right") - 1
        start = firsts[run] + position - run_at[run]
        order = np.lexsort((start, texts[run]))
        found: dict[int, tuple[list[list[int]], set[str]]] = {}
        for text, a, w in zip(
            texts[run][order].tolist(), start[order].tolist(), which[order].tolist()
        ):
            spans, items = found.setdefault(text, ([], set()))
            b = a + int(self.lengths[w])
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
            items |= self.items[w]
        return found


def leaks_in(phrases: Phrases, texts) -> list[tuple[int, list[tuple], list[str]]]:
    """(number of words, spans, items) of each text, shard by shard."""
    out: list = [None] * len(texts)
    symbols, owners = [], []

    def flush():
        nonlocal symbols, owners
        if symbols:
            for i, (merged, items) in phrases.search(symbols, owners).items():
                out[i] = (out[i][0], _placed(texts[i], merged), sorted(items))
        symbols, owners = [], []

    for i, text in enumerate(texts):
        n, own, places = phrases.runs(text or "")
        out[i] = (n, [], [])
        symbols += own
        owners += [(i, first, length) for first, length in places]
        if len(symbols) >= SHARD_WORDS:
            flush()
    flush()
    return out


def _placed(text: str, merged: list[list[int]]) -> list[tuple[int, int, int, int]]:
    """Add the code points that the spans of words cover."""
    at = {}
    wanted = {a for a, _ in merged} | {b - 1 for _, b in merged}
    for i, m in enumerate(_WORD.finditer(text)):
        if i in wanted:
            at[i] = m.span()
    return [(a, b - a, at[a][0], at[b - 1][1]) for a, b in merged]


def _leak(text: Column, items: tuple[tuple[str, str], ...], window: int) -> Column:
    fields = ("first_word", "n_words", "start", "end")

    @F.pandas_udf(LEAK)
    def find(texts: pd.Series) -> pd.DataFrame:
        phrases = worker_model(("phrases", items, window), lambda: Phrases(items, window))
        found = leaks_in(phrases, list(texts))
        return pd.DataFrame({
            "n_words": [n for n, _, _ in found],
            "spans": [[dict(zip(fields, s)) for s in spans] for _, spans, _ in found],
            "items": [items for _, _, items in found],
        })

    return find(text)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> tuple[int, Iterator[tuple]]:
    """The number of blocks, and items of each block as (id, text), collected when asked for;
    ids that are NULL read ``null``."""
    items = benchmark.filter(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
        F.col(text_col).alias("t"),
    ).distinct()
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = 1 + total // BLOCK_CHARS

    def collected(block: DataFrame) -> tuple:
        return tuple(sorted(map(tuple, block.collect())))

    if n == 1:
        return n, iter([collected(items)])
    spark, path = benchmark.sparkSession, work_path(benchmark.sparkSession, "items")
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "t"), F.lit(n)))
    dealt.repartition("block").write.partitionBy("block").parquet(path)
    every = spark.read.schema("item string, t string, block long").parquet(path)
    return n, (
        collected(every.filter(F.col("block") == b).select("item", "t")) for b in range(n)
    )


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, out: str = "leak",
) -> DataFrame:
    """``docs`` with a struct ``out``: ``n_words``, removal ``spans`` and sorted ``items``.

    A span has its first word, number of words, and code points (end exclusive). Items without
    words match nothing; NULL texts have no words; ids of items are text, repeated ids count
    once. Repeated documents each get their result, and empty tables give no rows or no spans.
    """
    n, blocks = _blocks(benchmark, item_col, item_text_col)
    if n == 1:
        return docs.withColumn(out, _leak(F.col(text_col), next(blocks), window))
    row = unused(docs, "row_number")
    marked = saved(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    passes = [
        saved(marked.select(row, _leak(F.col(text_col), b, window).alias("leak")), "leaks")
        for b in blocks
    ]
    together = functools.reduce(DataFrame.unionByName, passes).groupBy(row).agg(
        F.max("leak.n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("leak.spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("leak.items")))).alias("items"),
    )  # one entry per block of items
    merged = together.select(row, F.struct("n_words", _merge("spans").alias("spans"), "items").alias(out))
    return marked.join(merged, row).drop(row)


def _merge(spans: str) -> Column:
    """Sorted spans with those that touch or overlap made one."""
    done = F.array().cast("array<struct<first_word:long,n_words:long,start:long,end:long>>")

    def step(acc, s):
        last = F.element_at(acc, -1)
        end = F.greatest(last["first_word"] + last["n_words"], s["first_word"] + s["n_words"])
        joined = F.struct(
            last["first_word"].alias("first_word"), (end - last["first_word"]).alias("n_words"),
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
        )
        touches = (F.size(acc) > 0) & (s["first_word"] <= last["first_word"] + last["n_words"])
        kept = F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(touches, F.concat(kept, F.array(joined))).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.col(spans), done, step)


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no window of any item occurs, in all their columns."""
    leak = unused(docs, "leak")
    marked = with_leaks(docs, benchmark, out=leak, **options)
    return marked.filter(F.size(F.col(leak)["spans"]) == 0).select(*docs.columns)
