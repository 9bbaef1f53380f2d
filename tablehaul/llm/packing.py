"""Bounded-space online packing of token sequences.

Each partition keeps at most ``OPEN_WINDOWS`` open windows of ``WINDOW`` tokens. A document
gives its full windows away at once; the rest goes whole into the open window that it fits
best, the one with the least room. When it fits none and no more may be opened, the fullest is
filled with the beginning of the rest and emitted, and what remains is placed again. At the end
of a partition its open windows are merged, the fullest first, so that at most one of them is
not full. These leftovers, less than a window a partition, carry their ids and are merged in
the same way in groups of ``MERGE`` partitions until one group is left. Only its last sequence
can be short; it is split at powers of two, which need no padding.

Pieces are written out once and read back, so that a lost executor costs no second encoding
and the numbers of sequences cannot change.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.tokens import bundles, encoder
from tablehaul.session import saved

WINDOW = 2048
OPEN_WINDOWS = 32
END_ID = 1
MERGE = 64
#: Pieces in one Arrow batch of the output, 8 MB at most.
BATCH = 1024

PIECE = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, open boolean"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ("open", pa.bool_()),
])

#: (document, start, ids as bytes, its number of tokens)
Piece = tuple[int | None, int, bytes, int]


class Packer:
    """Open windows of one partition; ``emit`` gets each finished list of pieces."""

    def __init__(self, emit, window: int = WINDOW, most_open: int = OPEN_WINDOWS):
        self.emit, self.window, self.most_open = emit, window, most_open
        self.open: list[list[Piece]] = []
        self.room: list[int] = []

    def _cut(self, piece: Piece, length: int) -> tuple[Piece, Piece]:
        doc, start, ids, total = piece
        return (doc, start, ids[:4 * length], total), (doc, start + length, ids[4 * length:], total)

    def add(self, piece: Piece) -> None:
        """Place a non-empty piece of any length."""
        doc, start, ids, total = piece
        full = len(ids) // 4 // self.window * self.window
        for at in range(0, full, self.window):
            self.emit([(doc, start + at, ids[4 * at:4 * (at + self.window)], total)])
        piece = (doc, start + full, ids[4 * full:], total)
        while length := len(piece[2]) // 4:
            best = min(
                (i for i, r in enumerate(self.room) if r >= length),
                key=self.room.__getitem__, default=-1,
            )
            if best < 0 and len(self.open) < self.most_open:
                self.open.append([])
                self.room.append(self.window)
                best = len(self.open) - 1
            if best >= 0:
                self._put(best, piece)
                return
            fullest = min(range(len(self.room)), key=self.room.__getitem__)
            head, piece = self._cut(piece, self.room[fullest])
            self._put(fullest, head)

    def _put(self, i: int, piece: Piece) -> None:
        self.open[i].append(piece)
        self.room[i] -= len(piece[2]) // 4
        if not self.room[i]:
            self.emit(self.open.pop(i))
            self.room.pop(i)

    def merge_open(self) -> list[Piece]:
        """Fill open windows from the emptiest ones; the pieces of the one left, if any."""
        while len(self.open) > 1:
            emptiest = max(range(len(self.room)), key=self.room.__getitem__)
            pieces = self.open.pop(emptiest)
            self.room.pop(emptiest)
            for piece in pieces:
                while len(piece[2]) and self.open:
                    fullest = min(range(len(self.room)), key=self.room.__getitem__)
                    head, piece = self._cut(piece, min(self.room[fullest], len(piece[2]) // 4))
                    self._put(fullest, head)
                if len(piece[2]):
                    self.add(piece)
        return self.open[0] if self.open else []


class _Rows:
    """Emitted sequences as Arrow batches, numbered from ``first``."""

    def __init__(self, first: int):
        self.next, self.rows, self.full = first, [], []

    def sequence(self, pieces: list[Piece], is_open: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            length = len(ids) // 4
            self.rows.append((doc, start, length, ids, total, self.next, offset, is_open))
            offset += length
        self.next += 1
        if len(self.rows) >= BATCH:
            self.full.append(self.batch())

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) if rows else [()] * len(_ARROW)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _ARROW)]
        return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)

    def ready(self) -> Iterator[pa.RecordBatch]:
        full, self.full = self.full, []
        yield from full


def _encode_and_pack(tokenizer_file: str, window: int, most_open: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer_file)
        end = np.array([END_ID], "<u4").tobytes()
        rows = _Rows(TaskContext.get().partitionId() << 32)
        packer = Packer(rows.sequence, window, most_open)
        for batch in batches:
            docs, texts = (c.to_pylist() for c in batch.columns)
            at = 0
            for texts in bundles(t or "" for t in texts):
                for ids in tokens.packed(texts):
                    ids += end
                    packer.add((docs[at], 0, ids, len(ids) // 4))
                    at += 1
                yield from rows.ready()
        if left := packer.merge_open():
            rows.sequence(left, is_open=True)
        yield from rows.ready()
        yield rows.batch()

    return run


def _merge_leftovers(first: int, window: int, most_open: int):
    """Pack the leftovers of one group of partitions, given in the order of their sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows(first + (TaskContext.get().partitionId() << 32))
        packer = Packer(rows.sequence, window, most_open)
        for batch in batches:
            for doc, start, ids, total in zip(*(c.to_pylist() for c in batch.columns)):
                packer.add((doc, start, ids, total))
            yield from rows.ready()
        if left := packer.merge_open():
            rows.sequence(left, is_open=True)
        yield from rows.ready()
        yield rows.batch()

    return run


def split_at_powers(pieces: list[Piece], window: int) -> list[list[Piece]]:
    """Cut one short sequence into sequences whose lengths are powers of two."""
    left, out = list(pieces), []
    total = sum(len(p[2]) // 4 for p in pieces)
    for bit in range(window.bit_length(), -1, -1):
        if not total >> bit & 1:
            continue
        need, own = 1 << bit, []
        while need:
            doc, start, ids, tokens = left.pop(0)
            take = min(need, len(ids) // 4)
            own.append((doc, start, ids[:4 * take], tokens))
            if 4 * take < len(ids):
                left.insert(0, (doc, start + take, ids[4 * take:], tokens))
            need -= take
        out.append(own)
    return out


def pack(
    docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, most_open: int = OPEN_WINDOWS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit numbers. NULL and empty texts are the end id
    alone, so every document has a piece; NULL ids stay NULL and repeated rows are documents
    of their own. An empty table gives no rows. No token is lost or padded in: all sequences
    have ``window`` tokens but the last few, whose lengths are different powers of two.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long"), text_col)
    first = saved(
        texts.mapInArrow(_encode_and_pack(tokenizer_file, window, most_open), PIECE),
        "packed", compression="zstd",
    )
    done, columns = [first.filter("not open")], [f.name for f in _ARROW][:-1]
    open_rows, level = first.filter("open"), 0
    while (n := open_rows.select("sequence_id").distinct().count()) > 1:
        level += 1
        groups = max(1, -(-n // MERGE))
        dealt = open_rows.withColumn("g", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
        merged = saved(
            dealt.repartition(groups, "g").sortWithinPartitions("g", "sequence_id", "offset")
            .select("doc_id", "start", "ids", "doc_tokens")
            .mapInArrow(_merge_leftovers(level << 56, window, most_open), PIECE),
            "leftovers", compression="zstd",
        )
        done.append(merged.filter("not open"))
        open_rows = merged.filter("open")
    last = [tuple(r) for r in open_rows.orderBy("offset").select(
        "doc_id", "start", "ids", "doc_tokens").collect()]  # less than one window
    rows = []
    for number, own in enumerate(split_at_powers(last, window)):
        offset = 0
        for doc, start, ids, total in own:
            length = len(ids) // 4
            rows.append((doc, start, length, bytes(ids), total, (level + 1 << 56) + number, offset))
            offset += length
    done.append(spark.createDataFrame(rows, PIECE.rsplit(",", 1)[0]))
    out = done[0].select(*columns)
    for part in done[1:]:
        out = out.unionByName(part.select(*columns))
    return out
