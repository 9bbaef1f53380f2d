"""Token ids as binary shards with a minimal perfect hash index over the document keys.

Documents are range-partitioned by key, so that shards and the documents in them ascend. Each
task streams the ids of its documents, each with the end id behind it, into one payload file of
raw little-endian numbers (two bytes each when the vocabulary allows, four otherwise), and then
writes an index file beside it:

* a header of ``HEADER``; the end of each document in the payload, counted in ids; its key;
* bit arrays, level by level: a key belongs to the first level in which no other key of that
  level's rest shares its bit, so the number of set bits before it is a number of its own,
  below the number of keys (a minimal perfect hash function);
* for each number a 32-bit fingerprint of the key, which turns foreign keys away, and the place
  of the key's first document.

A key is thus found by one probe per level (1.6 on average), one rank and one comparison, and its
ids by one ranged read, however large the shard is. The key is compared as well, so a foreign key
is never found by chance. Documents that share a key lie next to each other; NULL keys come first
and are counted in the header instead of hashed.

Files are written under new names by every try of a task and only those of the written manifest
count, so a lost executor leaves nothing wrong behind. Both files are read and written by
``pyarrow.fs`` in the shared folder (see ``stores``).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.llm import stores
from tablehaul.llm.byte_ids import byte_encoder
from tablehaul.llm.tokens import bundles
from tablehaul.operators.joins import estimated_bytes
from tablehaul.session import PARTITION_BYTES, saved, work_path

END_ID = 0
MAGIC = b"TIDX0001"
#: Magic, bytes of an id, levels, documents, documents without key, distinct keys, ids.
HEADER = struct.Struct("<8sIIQQQQ")
#: Bits of a level for each key that is left; more bits mean fewer levels.
GAMMA = 2.0
#: Bytes of a payload read at a time, and ids of one Arrow batch of the output.
PART = 1 << 22
BATCH_ROWS = 2_000
#: Characters of text encoded at a time.
CHARS = 8_000_000
#: Estimates above this are Catalyst's mark for tables of unknown size.
UNKNOWN = 1 << 60

_U = np.uint64


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A one-to-one mixture of 64-bit numbers (the finaliser of SplitMix64)."""
    x = keys.astype(np.uint64) + _U((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ x >> _U(30)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> _U(27)) * _U(0x94D049BB133111EB)
    return x ^ x >> _U(31)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 20) >> _U(32)).astype(np.uint32)


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct 64-bit keys, from bit arrays in levels of 64-bit words."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before, total = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.before.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())
        self.size = total

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, rest = [], keys.view(np.uint64)
        while len(rest):
            words = -(-int(len(rest) * GAMMA) // 64)
            at = mixed(rest, len(levels)) % _U(64 * words)
            alone = np.bincount(at.astype(np.int64), minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8").copy())
            rest = rest[~alone[at]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; any number, or -1, for keys it was not made of."""
        out = np.full(len(keys), -1, np.int64)
        rest, waiting = np.ascontiguousarray(keys, np.int64).view(np.uint64), np.arange(len(keys))
        for level, (words, before) in enumerate(zip(self.levels, self.before)):
            if not len(waiting):
                break
            at = mixed(rest, level) % _U(64 * len(words))
            word, bit = (at >> _U(6)).astype(np.int64), at & _U(63)
            held = words[word] >> bit & _U(1) == 1
            below = words[word] & ((_U(1) << bit) - _U(1))
            number = before[word] + np.bitwise_count(below)
            out[waiting[held]] = number[held]
            rest, waiting = rest[~held], waiting[~held]
        return out


class ShardWriter:
    """One shard: a payload that grows document by document, and the index at its end."""

    def __init__(self, store, root: str, dtype: np.dtype):
        self.store, self.dtype, self.name = store, dtype, uuid.uuid4().hex
        self.root, self.keys, self.ends, self.missing, self.total = root, [], [], 0, 0
        store.create_dir(root, recursive=True)
        self.out = store.open_output_stream(f"{root}/{self.name}.ids", compression=None)

    def add(self, key: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.total += len(ids) // self.dtype.itemsize
        self.ends.append(self.total)
        self.keys.append(0 if key is None else key)
        self.missing += key is None

    def close(self) -> tuple:
        """Finish both files: (name, documents, those without key, ids, least and largest key)."""
        self.out.close()
        keys = np.array(self.keys, "<i8")
        own = keys[self.missing:]
        first = np.flatnonzero(np.diff(own, prepend=own[:1] - 1))
        index = PerfectHash.of(own[first])
        slot = index.numbers(own[first])
        prints, places = np.empty(len(first), "<u4"), np.empty(len(first), "<u8")
        prints[slot], places[slot] = fingerprints(own[first]), first + self.missing
        sizes = np.array([len(w) for w in index.levels], "<u8")
        with self.store.open_output_stream(f"{self.root}/{self.name}.idx", compression=None) as out:
            out.write(HEADER.pack(
                MAGIC, self.dtype.itemsize, len(sizes), len(keys), self.missing, len(first), self.total
            ))
            for part in (np.array(self.ends, "<u8"), keys, sizes, *index.levels, prints, places):
                out.write(part.tobytes())
        least, most = (int(own[0]), int(own[-1])) if len(own) else (None, None)
        return self.name, len(keys), self.missing, self.total, least, most


class Shard:
    """A written shard, opened for keyed reads."""

    def __init__(self, store, root: str, name: str):
        self.store, self.path = store, f"{root}/{name}"
        with store.open_input_stream(f"{self.path}.idx", compression=None) as raw:
            def section(dtype: str, n: int) -> np.ndarray:
                return np.frombuffer(raw.read(np.dtype(dtype).itemsize * n), dtype)

            magic, width, levels, docs, self.missing, keys, self.total = HEADER.unpack(raw.read(HEADER.size))
            if magic != MAGIC:
                raise ValueError(f"{self.path}.idx is no index of token ids")
            self.dtype = np.dtype(f"<u{width}")
            self.ends, self.keys = section("<u8", docs).astype(np.int64), section("<i8", docs)
            sizes = section("<u8", levels)
            self.index = PerfectHash([section("<u8", int(n)) for n in sizes])
            self.prints, self.places = section("<u4", keys), section("<u8", keys).astype(np.int64)
        if len(self.places) != keys or self.index.size != keys:
            raise ValueError(f"{self.path}.idx is cut off")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of the first document of each key, -1 for keys that the shard does not hold."""
        if not len(self.places):
            return np.full(len(keys), -1, np.int64)
        number = self.index.numbers(keys)
        known = np.maximum(number, 0)
        place = self.places[known]
        held = (number >= 0) & (self.prints[known] == fingerprints(keys.view(np.uint64)))
        return np.where(held & (self.keys[place] == keys), place, -1)

    def documents(self, places: np.ndarray) -> np.ndarray:
        """Places of all documents that share a key with those at ``places``, ascending."""
        if not len(places):
            return places
        places = np.sort(places)
        after = np.searchsorted(self.keys[self.missing:], self.keys[places], side="right") + self.missing
        return np.concatenate([np.arange(a, b) for a, b in zip(places, after)])

    def read(self, places: np.ndarray, with_ids: bool) -> Iterator[tuple]:
        """(key, first id, number of ids, checksum, ids or None) of documents in payload order."""
        with self.store.open_input_file(f"{self.path}.ids") as raw:
            width, at, held = self.dtype.itemsize, 0, b""  # ``held`` lies at byte ``at``

            def part(begin: int, end: int) -> bytes:
                """Bytes of the payload, read ahead when documents follow each other."""
                nonlocal at, held
                if begin < at or end > at + len(held):
                    raw.seek(begin)
                    at, held = begin, raw.read(max(end - begin, PART))
                return held[begin - at:end - at]

            for place in places.tolist():
                first = int(self.ends[place - 1]) if place else 0
                last, checksum, kept = int(self.ends[place]), 0, []
                for begin in range(first * width, last * width, PART):
                    data = part(begin, min(begin + PART, last * width))
                    if width < 4:
                        data = np.frombuffer(data, self.dtype).astype("<u4").tobytes()
                    checksum = zlib.crc32(data, checksum)
                    if with_ids:
                        kept.append(data)
                key = None if place < self.missing else int(self.keys[place])
                yield key, first, last - first, checksum, b"".join(kept) if with_ids else None


_MANIFEST = "shard long, name string, docs long, missing long, ids long, least long, most long"


def _writer(tokenizer_file: str, folder: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_encoder(tokenizer_file)
        end, shard = np.array([end_id], tokens.dtype).tobytes(), None
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            for own in bundles((t or "" for t in texts), CHARS):
                if shard is None:
                    shard = ShardWriter(*stores.opened(folder), tokens.dtype)
                for ids in tokens.packed(own):
                    shard.add(keys[at], ids + end)
                    at += 1
        if shard is not None:
            row = (TaskContext.get().partitionId(), *shard.close())
            yield pa.RecordBatch.from_arrays([
                pa.array([v], pa.string() if isinstance(v, str) else pa.int64()) for v in row
            ], names=["shard", "name", "docs", "missing", "ids", "least", "most"])

    return run


def write_shards(
    docs: DataFrame, tokenizer_file: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, shards: int | None = None,
) -> DataFrame:
    """Write the ids of all documents in ascending order of their keys, and return the manifest.

    NULL texts are empty. Equal keys are ordered by a hash of their text; rows that agree in both
    are interchangeable and may be dealt to several shards. An empty table has no shard. The
    manifest has a row per shard: ``shard, name, docs, missing, ids, least, most, start``, in
    which ``missing`` documents have no key and ``start`` counts the ids of all shards before.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    if shards is None:
        size = 3 * estimated_bytes(docs.select(id_col, text_col))  # Parquet grows about threefold
        if size > UNKNOWN:
            size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    by = [F.col("key").asc_nulls_first(), F.col("hash").asc(), F.col("tie").asc()]
    dealt = rows.withColumn("hash", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn(
        "tie", F.monotonically_increasing_id()
    ).repartitionByRange(shards, *by).sortWithinPartitions(*by).select("key", "text")
    written = saved(dealt.mapInArrow(_writer(tokenizer_file, folder, end_id), _MANIFEST), "shard-manifest")
    # One small row per shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return saved(
        written.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0))), "shard-starts"
    )


_FOUND = "key long, start long, n_tokens long, ids_crc32 long, ids binary"
_FOUND_SCHEMA = pa.schema([
    ("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
    ("ids", pa.binary()),
])


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += len(row[4] or b"")
        if len(out) == BATCH_ROWS or size >= PART:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND_SCHEMA)], schema=_FOUND_SCHEMA
            )
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND_SCHEMA)], schema=_FOUND_SCHEMA
        )


def _read(shard: Shard, start: int, places: np.ndarray, with_ids: bool) -> Iterator[tuple]:
    for key, first, n, checksum, ids in shard.read(places, with_ids):
        yield key, start + first, n, checksum, ids


def read_shards(manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """``key, start, n_tokens, ids_crc32, ids`` of every document, shard by shard.

    Each key that the index lists is looked up as ``fetch`` does it, so a wrong index shows.
    ``ids`` are little-endian unsigned 32-bit numbers, NULL unless wanted; ``ids_crc32`` is their
    checksum, taken part by part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = stores.opened(folder)
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns)):
                shard = Shard(store, root, name)
                keys = np.unique(shard.keys[shard.missing:])
                places = shard.find(keys)
                if (places < 0).any():
                    raise ValueError(f"{shard.path}.idx does not find its own keys")
                places = np.concatenate([np.arange(shard.missing), shard.documents(places)])
                if len(places) != len(shard.keys):
                    raise ValueError(f"{shard.path}.idx does not find all its documents")
                yield from _batches(_read(shard, start, places, with_ids))

    n = max(1, manifest.count())
    return manifest.select("name", "start").repartitionByRange(n, "start", "name").mapInArrow(run, _FOUND)


def fetch(
    manifest: DataFrame, folder: str, keys: DataFrame, key_col: str, with_ids: bool = True,
) -> DataFrame:
    """The documents of the wanted keys, as ``read_shards`` gives them.

    Repeated keys count once; NULL keys find the documents without key; keys that no document has
    give no row. A shard is asked only for keys within its range, and read only where they lie.
    """
    wanted = keys.select(F.col(key_col).cast("long").alias("want")).distinct()
    # Three numbers per shard are known to the tasks; a shard holds PARTITION_BYTES of text.
    cuts = manifest.orderBy("shard").select("shard", "missing", "least", "most").toPandas()
    lonely = cuts["shard"][cuts["missing"] > 0].to_numpy(np.int64)
    cuts = cuts.dropna(subset=["least"])
    places, least, most = (cuts[c].to_numpy(np.int64) for c in ("shard", "least", "most"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            own = column.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            first, after = np.searchsorted(most, own, "left"), np.searchsorted(least, own, "right")
            n = np.maximum(after - first, 0)  # a key's documents may reach over several shards
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            shard, want = places[np.repeat(first, n) + step], pa.array(np.repeat(own, n))
            if column.null_count:
                shard = np.concatenate([shard, lonely])
                want = pa.concat_arrays([want, pa.nulls(len(lonely), pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array(shard), want], names=["of", "want"])

    routed = wanted.mapInArrow(route, "of long, want long")
    asked = routed.join(manifest.select("shard", "name", "start"), F.col("of") == F.col("shard"))
    asked = asked.select("name", "start", "want").repartition("name").sortWithinPartitions("name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = stores.opened(folder)

        def answers(name: str, start: int, want: list) -> Iterator[pa.RecordBatch]:
            shard = Shard(store, root, name)
            own = np.array(sorted(k for k in want if k is not None), np.int64)
            places = shard.find(own)
            places = shard.documents(places[places >= 0])
            if None in want:
                places = np.concatenate([np.arange(shard.missing), places])
            yield from _batches(_read(shard, start, places, with_ids))

        current, want = None, []
        for batch in batches:
            for name, start, key in zip(*(c.to_pylist() for c in batch.columns)):
                if current and name != current[0]:
                    yield from answers(*current, want)
                    want = []
                current = name, start
                want.append(key)
        if current:
            yield from answers(*current, want)

    return asked.mapInArrow(run, _FOUND)


def keyed(docs: DataFrame, tokenizer_file: str, folder: str | None = None, with_ids: bool = True) -> DataFrame:
    """Write the documents as shards and read all of them back."""
    folder = folder or work_path(docs.sparkSession, "token-shards")
    return read_shards(write_shards(docs, tokenizer_file, folder), folder, with_ids)
