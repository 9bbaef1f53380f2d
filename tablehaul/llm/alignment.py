"""Alignment of two tokenizers over a corpus, with pairs counted by external spilling.

Tokens of tokenizer A (byte-level) and B (pieces) of the same text are cut into groups at the
byte offsets where tokens of both end; all occurrence pairs inside a group are linked. The count
of an id pair is the number of documents that hold it linked, corpus-wide.

Counting goes through runs in the shared folder, as rows of compressed blocks:

1. *Spill.* A task encodes its documents in runs of about ``RUN_CHARS`` characters. The
   pair-document records of a run, sorted side-major (A id, B id, document), are cut by radix of
   the A id into ``RADIX`` blocks. A block has a head (distinct pairs and how many documents of
   the run hold each) and a body (documents and numbers of links), both in zstd.
2. *Merge.* The heads of at most ``FAN_IN`` runs of a radix meet in one task item, where a k-way
   heap merge adds up the counts of equal pairs; its blocks are merged again, until each radix
   has one. As it goes side by side through the A ids, the largest count of an id is known when
   its pairs end.
3. *Contributions.* The totals of a radix are sent to each group of ``FAN_IN`` runs. A task takes
   them once and streams the run blocks by, whose bodies turn into sums for each document of the
   run; the sums of a run's radixes are added up.

A pair that every document holds is one entry in the head of each run, and a record leaves its
run's body only as part of a sum, so no task gets the documents of a pair, or the pairs of a hot
id, together. Runs are rows of a written table; nothing has to be encoded again when an executor
is lost.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.byte_ids import MEMORY, PLAIN, WORD, ByteEncoder, WordMemory
from tablehaul.llm.common import worker_model
from tablehaul.llm.tokens import bundles
from tablehaul.session import saved

#: Characters and documents of one run, about; a longer document is a run of its own.
RUN_CHARS = 8_000_000
RUN_DOCS = 50_000
BUNDLE = 2_000_000
RADIX = 64
FAN_IN = 64
#: A pair is one number: the A id times this, and the B id.
SIDE = 1 << 24
#: Rows of one Arrow batch of document figures.
BATCH = 2_000


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of non-negative numbers, each as narrow as it can be, in one zstd frame."""
    parts = []
    for c in columns:
        kind = np.min_scalar_type(int(c.max()) if len(c) else 0).str[1:]
        parts.append(f"{kind}{len(c)}\n".encode() + c.astype(f"<{kind}").tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unsqueezed(data: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(data):
        end = data.index(b"\n", at)
        kind, n = np.dtype(f"<{data[at:at + 2].decode()}"), int(data[at + 2:end])
        at = end + 1 + n * kind.itemsize
        out.append(np.frombuffer(data, kind, n, end + 1).astype(np.int64))
    return out


def head(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending pairs, as distances, and their counts."""
    return squeezed(np.diff(pairs, prepend=0), counts)


def head_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = unsqueezed(data)
    return np.cumsum(steps), counts


class Aligner(WordMemory):
    """Groups and links of words under both tokenizers.

    A word's number is its place in the tables: numbers of tokens, groups and links, its groups
    written out, and its pairs with their numbers of links. Words stand for themselves, as both
    tokenizers cut in front of a blank and, where the vocabulary of B allows, between letters,
    numerals, signs and line breaks.
    """

    def __init__(self, a_file: str, b_file: str):
        super().__init__()
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as formats

        self.a = ByteEncoder(a_file, special_text=True)
        self.b = SentencePieceProcessor(model_file=b_file)
        places = {c: bytes([i]) for i, c in enumerate(self.a.letters)}
        self.a_bytes = {
            i: b"".join(places.get(c, c.encode()) for c in token)
            for token, i in self.a.tokenizer.get_vocab().items()
        }
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        model = formats.ModelProto()
        with open(b_file, "rb") as f:
            model.ParseFromString(f.read())
        normal = model.normalizer_spec
        usual = [p.lstrip("▁") for i, p in enumerate(pieces) if not (
            self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)
        )]
        own_symbols = any(p.type == p.USER_DEFINED for p in model.pieces)
        self.by_chunk = self.a.by_chunk and not (
            normal.precompiled_charsmap or normal.remove_extra_whitespaces or own_symbols
            or any("▁" in p for p in usual)
        ) and normal.add_dummy_prefix and normal.escape_whitespaces
        # No piece reaches over the end of a word if none holds letters beside signs and so on.
        self.by_word = not any(PLAIN.fullmatch(p) and len(WORD.findall(p)) > 1 for p in usual) and not any(
            "\n" in p for p in usual
        )
        self.line = self.b.encode("\n")
        self._clear()

    def _clear(self) -> None:
        self.behind.clear()
        self.others.clear()
        self.n_a, self.n_b, self.n_groups, self.n_links = (array("q") for _ in range(4))
        self.written: list[str] = []
        self.pairs, self.links, self.ends = array("q"), array("q"), array("q", [0])
        self.broken: set[int] = set()

    def forget(self) -> None:
        if len(self.written) > MEMORY:
            self._clear()

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        words = [c for c in chunks if self.by_word and c.isalpha() and c.isascii()]
        self.ahead = dict(zip(words, self.b.encode(words, num_threads=1)))
        try:
            return super().learn(chunks)
        finally:
            self.ahead = {}

    ahead: dict[str, list[int]] = {}

    def encoded_word(self, word: str, blank: str) -> bytes:
        if blank:
            b = self.ahead.get(word)
            b = self.b.encode(word) if b is None else b
        else:
            b = self.b.encode(f"\n{word}")[len(self.line):]
        return self._unit(blank + word, self.a.word_ids(word, blank), b)

    def encoded(self, text: str) -> bytes:
        """The number of a text that begins with a blank; B adds that blank itself."""
        return self._unit(text, self.a.whole(text), self.b.encode(text[1:]))

    def _unit(self, text: str, a: list[int], b: list[int]) -> bytes:
        """Enter a word of both tokenizers; its number as four bytes."""
        number = len(self.written)
        a_bytes, b_bytes, whole = self.a_bytes, self.b_bytes, text.encode()
        if b"".join([a_bytes[i] for i in a]) != whole or b"".join([b_bytes[i] for i in b]) != whole:
            self.broken.add(number)
            a = b = []
        groups, links = [], 0
        i = j = at_a = at_b = 0
        while i < len(a):
            from_a, from_b = i, j
            at_a += len(a_bytes[a[i]])
            at_b += len(b_bytes[b[j]])
            i, j = i + 1, j + 1
            while at_a != at_b:
                if at_a < at_b:
                    at_a += len(a_bytes[a[i]])
                    i += 1
                else:
                    at_b += len(b_bytes[b[j]])
                    j += 1
            own_a, own_b = a[from_a:i], b[from_b:j]
            groups.append(f"{','.join(map(str, own_a))}|{','.join(map(str, own_b))}")
            links += len(own_a) * len(own_b)
            if len(own_a) == len(own_b) == 1:
                self.pairs.append(own_a[0] * SIDE + own_b[0])
                self.links.append(1)
                continue
            times_b = Counter(own_b).items()
            for x, n in Counter(own_a).items():
                for y, m in times_b:
                    self.pairs.append(x * SIDE + y)
                    self.links.append(n * m)
        self.n_a.append(len(a))
        self.n_b.append(len(b))
        self.n_groups.append(len(groups))
        self.n_links.append(links)
        self.written.append(";".join(groups))
        self.ends.append(len(self.pairs))
        return number.to_bytes(4, "little")

    def figures(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """(A tokens, B tokens, groups, links, digest of the groups) of each text, and the records:
        text, pair and number of links, by text and pair."""
        words = [np.frombuffer(w, "<u4") for w in self.packed(texts, behind=True)]
        tables = [np.frombuffer(t, np.int64) if len(t) else np.empty(0, np.int64) for t in (
            self.n_a, self.n_b, self.n_groups, self.n_links, self.ends, self.pairs, self.links
        )]
        *numbers, ends, pairs, links = tables
        broken = np.array(sorted(self.broken), np.int64)
        written, rows, used = self.written, [], []
        for i, (text, own) in enumerate(zip(texts, words)):
            if not text or len(broken) and np.isin(own, broken).any():
                rows.append((0, 0, 0, 0, ""))
                continue
            digest = hashlib.sha256(";".join([written[w] for w in own.tolist()]).encode()).hexdigest()
            rows.append((*[int(n[own].sum()) for n in numbers], digest))
            used.append(own.astype(np.int64) + (i << 32))
        if not used:
            return rows, *[np.empty(0, np.int64)] * 3
        places, times = np.unique(np.concatenate(used), return_counts=True)
        text, word = places >> 32, places & 0xFFFFFFFF
        size = ends[word + 1] - ends[word]
        at = np.arange(size.sum()) + np.repeat(ends[word] - np.cumsum(size) + size, size)
        return rows, *summed(np.repeat(text, size), pairs[at], links[at] * np.repeat(times, size))


def summed(text: np.ndarray, pair: np.ndarray, links: np.ndarray) -> tuple:
    """Records with one row per text and pair, by text and pair."""
    distinct, rank = np.unique(pair, return_inverse=True)
    place, at = np.unique(text * len(distinct) + rank, return_inverse=True)
    out = np.zeros(len(place), np.int64)
    np.add.at(out, at, links)
    return place // max(1, len(distinct)), distinct[place % max(1, len(distinct))], out


_SPILLED = (
    "run long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, radix int, head binary, body binary"
)
_SPILLED_SCHEMA = pa.schema([
    ("run", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
    ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("radix", pa.int32()), ("head", pa.binary()), ("body", pa.binary()),
])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def run_blocks(text: np.ndarray, pair: np.ndarray, links: np.ndarray, radix: int) -> Iterator[tuple]:
    """(radix, head, body) of a run's records, which may come in any order."""
    side = pair // SIDE % radix
    order = np.lexsort((text, pair, side))
    text, pair, links, side = text[order], pair[order], links[order], side[order]
    cuts = np.searchsorted(side, np.arange(radix + 1))
    for r in range(radix):
        own = slice(cuts[r], cuts[r + 1])
        if own.start < own.stop:
            distinct, counts = np.unique(pair[own], return_counts=True)
            yield r, head(distinct, counts), squeezed(text[own], links[own])


def _spill(a_file: str, b_file: str, run_chars: int, radix: int):
    """Documents to their figures and to the blocks of their runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_model(("aligner", a_file, b_file), lambda: Aligner(a_file, b_file))
        number, place, chars, records = TaskContext.get().partitionId() << 32, 0, 0, []

        def blocks() -> Iterator[pa.RecordBatch]:
            nothing = (None,) * 7
            columns = [np.concatenate(c) for c in zip(*records)]
            for r, top, body in run_blocks(*columns, radix):
                yield _batch([(number, *nothing, r, top, body)], _SPILLED_SCHEMA)

        for batch in batches:
            docs, texts = (c.to_pylist() for c in batch.columns)
            at = 0
            for own in bundles((t or "" for t in texts), BUNDLE):
                rows, text, pair, links = words.figures(own)
                records.append((text + place, pair, links))
                for i in range(0, len(rows), BATCH):
                    yield _batch([
                        (number, place + i + k, docs[at + i + k], *row, None, None, None)
                        for k, row in enumerate(rows[i:i + BATCH])
                    ], _SPILLED_SCHEMA)
                at, place, chars = at + len(own), place + len(own), chars + sum(map(len, own))
                if chars >= run_chars or place >= RUN_DOCS:
                    yield from blocks()
                    number, place, chars, records = number + 1, 0, 0, []
        if records:
            yield from blocks()

    return run


def merged(heads: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The k-way heap merge of ascending heads: each pair once, with the sum of its counts."""
    pairs, counts, last = array("q"), array("q"), -1
    for pair, n in heapq.merge(*[zip(p.tolist(), c.tolist()) for p, c in heads]):
        if pair == last:
            counts[-1] += n
        else:
            pairs.append(pair)
            counts.append(n)
            last = pair
    return tuple(np.array(x, np.int64) for x in (pairs, counts))


def best_of(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the largest of its A id; pairs ascend, so ids are together."""
    if not len(pairs):
        return np.empty(0, bool)
    side = pairs // SIDE
    first = np.flatnonzero(np.diff(side, prepend=-1))
    most = np.maximum.reduceat(counts, first)
    return counts == np.repeat(most, np.diff(first, append=len(side)))


def _by_group(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Sorted rows of batches by their first columns."""
    current, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and row[:keys] != current:
                yield current, rows
                rows = []
            current = row[:keys]
            rows.append(row[keys:])
    if rows:
        yield current, rows


_HEADS = pa.schema([("radix", pa.int32()), ("run", pa.int64()), ("head", pa.binary())])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (radix, group), rows in _by_group(batches, 2):
        top = rows[0][0] if len(rows) == 1 else head(*merged([head_of(r[0]) for r in rows]))
        yield _batch([(radix, group, top)], _HEADS)


def pair_counts(heads: DataFrame, runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """``radix, head`` with the corpus-wide counts, from the heads of all runs, level by level."""
    while runs > 1:
        runs = -(-runs // fan_in)
        group = F.pmod(F.xxhash64("run"), F.lit(runs)).alias("run")
        dealt = heads.select("radix", group, "head").repartition("radix", "run")
        dealt = dealt.sortWithinPartitions("radix", "run")
        heads = saved(dealt.mapInArrow(_merge, "radix int, run long, head binary"), "pair-heads")
    return heads.select("radix", "head")


_SUMS = pa.schema([("run", pa.int64()), ("sums", pa.binary())])


def _contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of a radix, then blocks of runs with that radix, to sums per document of a run."""
    pairs = counts = best = None
    for batch in batches:
        for _, _, run, top, body in zip(*(c.to_pylist() for c in batch.columns)):
            if run is None:
                pairs, counts = head_of(top)
                best = best_of(pairs, counts)
                continue
            own, n = head_of(top)
            text, links = unsqueezed(body)
            at = np.repeat(np.searchsorted(pairs, own), n)
            docs, place = np.unique(text, return_inverse=True)
            n_best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
            np.add.at(n_best, place, links * best[at])
            np.add.at(total, place, links * counts[at])
            yield _batch([(run, squeezed(docs, n_best, total))], _SUMS)


_FIGURES = pa.schema([
    ("run", pa.int64()), ("place", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (run,), rows in _by_group(batches, 1):
        parts = [unsqueezed(r[0]) for r in rows]
        docs = np.unique(np.concatenate([p[0] for p in parts]))
        sums = np.zeros((2, len(docs)), np.int64)
        for own, n_best, total in parts:
            at = np.searchsorted(docs, own)
            sums[:, at] += (n_best, total)
        for i in range(0, len(docs), BATCH):
            part = slice(i, i + BATCH)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(docs[part]), run)), pa.array(docs[part].astype(np.int32)),
                pa.array(sums[0, part]), pa.array(sums[1, part]),
            ], schema=_FIGURES)


def aligned(
    docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text",
    run_chars: int = RUN_CHARS, radix: int = RADIX, fan_in: int = FAN_IN,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    NULL and empty texts, and texts that a tokenizer does not give back byte by byte, have no
    tokens: zeros and an empty string. NULL ids stay NULL, repeated rows are documents of their
    own, links of very long texts are summed like others, and an empty table gives no row. An A
    id's best pairs include ties.
    """
    texts = docs.select(F.col(id_col).cast("long"), text_col)
    spilled = saved(
        texts.mapInArrow(_spill(a_file, b_file, run_chars, radix), _SPILLED), "pair-runs",
        compression="uncompressed",
    )
    figures = spilled.filter("radix is null").select(
        "run", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"
    )
    blocks = spilled.filter("radix is not null")
    runs = blocks.agg(F.count_distinct("run")).first()[0]
    totals = pair_counts(blocks.select("radix", "run", "head"), runs, fan_in)
    groups = max(1, -(-runs // fan_in))
    sent = totals.select(
        "radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("of"),
        F.lit(None).cast("long").alias("run"), "head", F.lit(None).cast("binary").alias("body"),
    )
    own = blocks.select("radix", F.pmod(F.xxhash64("run"), F.lit(groups)).alias("of"), "run", "head", "body")
    dealt = sent.unionByName(own).repartition("radix", "of").sortWithinPartitions(
        "radix", "of", F.col("run").asc_nulls_first()
    )
    sums = dealt.mapInArrow(_contribute, "run long, sums binary").repartition("run")
    added = sums.sortWithinPartitions("run").mapInArrow(
        _add_up, "run long, place int, n_best long, count_sum long"
    )
    found = figures.join(added, ["run", "place"], "left")
    zero = F.lit(0).cast("long")
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
