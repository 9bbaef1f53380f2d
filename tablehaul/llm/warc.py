"""WARC archives written and read as streams of chunks.

Writing: pages with equal payloads of at least ``REVISIT_BYTES`` become one response and
revisits of it. Each task streams its records into one archive of gzip members, one per
record, in the shared folder; the files of tasks that were run again are ignored, since only
those in the written manifest count.

Reading: each archive is one stream. A payload never has to be in memory as a whole: it becomes
rows of record id and chunk number with the bytes of the chunk and the count and SHA-1 of the
payload so far, so that the last chunk of a record carries its digest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm import stores
from tablehaul.llm.common import same, text_of
from tablehaul.session import saved, work_path

# The version line, field names and types of the archive format.
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

REVISIT_BYTES = 1000
#: Bytes of a payload in one chunk row, and of an archive read or written at a time.
CHUNK = 65_536
#: Chunk rows in one Arrow batch.
BATCH_ROWS = 64

_ID = re.compile(rb"<urn:x-page:(-?[0-9]+|null)>")


def plan_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
) -> DataFrame:
    """``id, url, payload, digest, bytes, refers_to`` per page; ``refers_to`` NULL: a response.

    The page with the largest id is the response of its payload; NULL ids rank lowest, and
    pages that share the response's id are responses too.
    """
    payload = text_of(payload_col).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"), F.sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    groups = (
        rows.filter(F.col("bytes") >= REVISIT_BYTES).groupBy("digest")
        .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    # Written out, so that the join shuffles plainly and AQE can split a digest of many pages.
    groups = saved(groups.select(F.col("digest").alias("d"), "first"), "payload-groups")
    refers = F.when(~same(F.col("id"), F.col("first")), F.col("first"))
    return rows.join(groups, F.col("digest") == F.col("d"), "left").select(
        "id", "url", "payload", "digest", "bytes", refers.alias("refers_to")
    )


def _urn(page) -> str:
    return f"<urn:x-page:{'null' if page is None else page}>"


def _field(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def _head(page, url, digest: str, refers_to, http: bytes, length: int) -> bytes:
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _urn(page)), ("WARC-Date", DATE),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _field(url)))
    if refers_to is None:
        fields.append(("Content-Type", "application/http; msgtype=response"))
    else:
        fields += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Length", str(len(http) + length)))
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return VERSION + b"\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + http


def _write_record(out, head: bytes, payload: memoryview) -> None:
    """One gzip member, compressed chunk by chunk."""
    gzip = zlib.compressobj(1, zlib.DEFLATED, 31)
    out.write(gzip.compress(head))
    for at in range(0, len(payload), CHUNK):
        out.write(gzip.compress(payload[at:at + CHUNK]))
    out.write(gzip.compress(b"\r\n\r\n"))
    out.write(gzip.flush())


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = stores.opened(folder)
        path, out, records = f"{root}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            ids, urls, payloads, digests, _, refers = batch.columns
            for i in range(batch.num_rows):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(path, compression=None)
                refers_to = refers[i].as_py()
                payload = memoryview(payloads[i].as_buffer())
                if refers_to is None:
                    http = HTTP % len(payload)
                else:
                    http, payload = b"", payload[:0]
                head = _head(
                    ids[i].as_py(), urls[i].as_py(), digests[i].as_py(), refers_to, http,
                    len(payload),
                )
                _write_record(out, head, payload)
                records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"path": [path.rsplit("/", 1)[1]], "records": [records]},
                schema=pa.schema([("path", pa.string()), ("records", pa.int64())]),
            )

    return run


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the planned records and return the manifest: ``path, records`` of each archive."""
    rows = records.select("id", "url", "payload", "digest", "bytes", "refers_to")
    return saved(rows.mapInArrow(_writer(folder), "path string, records long"), "manifest")


class Stream:
    """Bytes of an archive of gzip members, a bounded part in memory at a time."""

    def __init__(self, raw):
        self.raw, self.gzip = raw, zlib.decompressobj(31)
        self.buffer, self.at, self.pending = b"", 0, b""

    def _fill(self) -> bool:
        """Get more plain bytes; False at the end of the archive."""
        self.buffer, self.at = self.buffer[self.at:], 0
        while True:
            if self.gzip.eof:
                self.pending = self.gzip.unused_data or self.raw.read(CHUNK)
                if not self.pending:
                    return False
                self.gzip = zlib.decompressobj(31)
            elif not self.pending:
                self.pending = self.raw.read(CHUNK)
            ended = not self.pending  # then the rest is in the decompressor, or nowhere
            plain = self.gzip.decompress(self.pending, CHUNK)
            self.pending = self.gzip.unconsumed_tail
            if plain:
                self.buffer += plain
                return True
            if ended:
                return False

    def line(self) -> bytes:
        """The next line without its end."""
        while (end := self.buffer.find(b"\r\n", self.at)) < 0:
            if not self._fill():
                raise EOFError("the archive ends inside a record")
        line, self.at = self.buffer[self.at:end], end + 2
        return line

    def take(self, most: int) -> bytes:
        """At least one byte and at most ``most``."""
        if self.at == len(self.buffer) and not self._fill():
            raise EOFError("the archive ends inside a record")
        part = self.buffer[self.at:self.at + most]
        self.at += len(part)
        return part

    def more(self) -> bool:
        return self.at < len(self.buffer) or self._fill()


def chunk_rows(raw) -> Iterator[tuple]:
    """(record, type, refers_to, chunk number, data, bytes so far, SHA-1 so far, last).

    A revisit has no payload of its own; its SHA-1 is the declared one. A payload that does not
    have its declared digest raises an error.
    """
    stream = Stream(raw)
    while stream.more():
        if stream.line() != VERSION:
            raise ValueError("a record does not begin with the version line")
        fields = {}
        while line := stream.line():
            name, _, value = line.partition(b":")
            fields[name.strip().lower()] = value.strip()
        left, kind = int(fields[b"content-length"]), fields[b"warc-type"].decode()
        refers = fields.get(b"warc-refers-to")
        record, refers = _page(fields[b"warc-record-id"]), refers and _page(refers)
        if kind == "response":
            while line := stream.line():
                left -= len(line) + 2
            left -= 2
        declared = base64.b32decode(fields[b"warc-payload-digest"].partition(b":")[2]).hex()
        digest, done, number = hashlib.sha1(), 0, 0
        while True:
            data = b""
            while left and len(data) < CHUNK:
                part = stream.take(min(left, CHUNK - len(data)))
                data, left = data + part, left - len(part)
            digest.update(data)
            done += len(data)
            so_far = digest.hexdigest() if kind == "response" else declared
            if not left and so_far != declared:
                raise ValueError(f"the payload of record {record} is damaged")
            yield record, kind, refers, number, data, done, so_far, not left
            number += 1
            if not left:
                break
        if stream.line() or stream.line():
            raise ValueError("a record does not end with two line ends")


def _page(urn: bytes) -> int | None:
    number = _ID.fullmatch(urn).group(1)
    return None if number == b"null" else int(number)


CHUNKS = (
    "record long, type string, refers_to long, chunk int, data binary, bytes long, sha1 string, "
    "last boolean"
)
_CHUNK_SCHEMA = pa.schema([
    ("record", pa.int64()), ("type", pa.string()), ("refers_to", pa.int64()),
    ("chunk", pa.int32()), ("data", pa.binary()), ("bytes", pa.int64()), ("sha1", pa.string()),
    ("last", pa.bool_()),
])


def _reader(folder: str):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), _CHUNK_SCHEMA)]
        return pa.RecordBatch.from_arrays(arrays, schema=_CHUNK_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = stores.opened(folder)
        for paths in batches:
            for path in paths.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{root}/{path}", compression=None) as raw:
                    for row in chunk_rows(raw):
                        rows.append(row)
                        if len(rows) == BATCH_ROWS:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    return run


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Chunk rows of all archives in the manifest.

    A record without payload has one chunk of no bytes. Archives are dealt out one to a task.
    """
    n = max(1, manifest.count())
    dealt = manifest.select("path").repartitionByRange(n, "path")
    return dealt.mapInArrow(_reader(folder), CHUNKS)


def archived(pages: DataFrame, folder: str | None = None, **columns: str) -> DataFrame:
    """Write all pages as archives, read them back, and return their chunk rows.

    NULL payloads are empty, NULL urls leave out the field, NULL ids read back as NULL.
    Repeated rows are records of their own. An empty table gives no archive and no row.
    """
    folder = folder or work_path(pages.sparkSession, "archives")
    return read_archives(write_archives(plan_records(pages, **columns), folder), folder)


def record_summary(chunks: DataFrame) -> DataFrame:
    """``record, type, refers_to, bytes, sha1`` per record; revisits have their response's."""
    last = saved(
        chunks.filter("last").select("record", "type", "refers_to", "bytes", "sha1"), "records"
    )
    responses = last.filter("type = 'response'")
    # Written out, so that AQE can split a response that very many pages revisit.
    own = saved(
        responses.select(
            F.col("record").alias("r"), F.col("sha1").alias("s"), F.col("bytes").alias("b")
        ).distinct(),
        "responses",
    )
    revisits = last.filter("type = 'revisit'").join(
        own, same(F.col("refers_to"), F.col("r")) & (F.col("sha1") == F.col("s")), "left"
    )
    return responses.unionByName(
        revisits.select("record", "type", "refers_to", F.col("b").alias("bytes"), "sha1")
    )
