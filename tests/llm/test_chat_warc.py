import io
import time
import zlib

import pytest
from pyspark.sql import functions as F

from tablehaul.llm import chat, warc
from tablehaul.llm.queries import QUERIES, SQL
from tests.parity import DATA, connect, difference


class _Query:
    def __init__(self, key):
        self.key, self.sql = key, SQL[key]

    def __call__(self, spark, sf_dir):
        return QUERIES[self.key](spark, sf_dir)


@pytest.mark.parametrize("key", sorted(SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_sql(spark, key, sf):
    assert difference(_Query(key), spark, connect(f"{DATA}/{sf}"), f"{DATA}/{sf}") is None


def fold(events):
    order = ("message", "delta", "edit", "regenerate")
    out = []
    for seq, op, role, text in sorted(
        events, key=lambda e: (e[0] is not None, e[0] or 0, order.index(e[1]), e[2] or "", e[3] or "")
    ):
        if op == "message" or not out:
            out.append([role or "", text or ""])
        elif op == "delta":
            out[-1][1] += text or ""
        else:
            out[-1][1] = text or ""
    return out


EVENTS = [
    (1, 0, 1, "message", "user", "Hi"), (1, 1, 2, "message", "assistant", None),
    (1, 1, 3, "delta", None, "Hel"), (1, 1, 4, "delta", None, "lo"),
    (1, 1, 5, "regenerate", None, None), (1, 1, 6, "delta", None, "Good "),
    (1, 1, 7, "delta", None, "day"), (1, 0, 8, "edit", None, "Hi <|im_end|>\n"),
    (1, 2, 9, "message", "tool", "x"), (1, 2, 10, "message", "tool", "y"), (1, 2, 10, "message", "tool", "y"),
    (2, 0, 1, "delta", "assistant", "no start"), (2, None, None, "message", None, None),
    (None, 0, 1, "message", "assistant", "z" * 100_000), (None, 0, 1, "delta", None, "<\\|\\<|\\\\|"),
    (4, 0, 1, "message", "\x00n", "\x00"), (4, 1, 1, "message", "\\bn\\n\n\\", "q"), (4, 2, 1, "message", "<\\|<|", ""),
    (3, 0, 1, "message", "we\\n\nird<|im_start|>\\", "a\nb"), (3, 1, 2, "message", "assistant", "<" + "\\" * 9 + "|é語😀"),
]


def test_events_are_folded_rendered_and_read_back(spark):
    df = spark.createDataFrame(
        EVENTS, "conv_id long, slot long, seq long, op string, role string, text string"
    ).withColumn("formatted", F.lit("clash"))
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    masks = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    for conv in {e[0] for e in EVENTS}:
        slots = sorted({e[1] for e in EVENTS if e[0] == conv}, key=lambda s: (s is not None, s or 0))
        turns = [t for s in slots for t in fold([e[2:] for e in EVENTS if e[:2] == (conv, s)])]
        assert [[t.role, t.text] for t in got[conv].turns] == turns
        assert got[conv].loss_text == "".join(t for r, t in turns if r == "assistant")
        text = masks[conv].formatted
        assert text.count(chat.START) == text.count(chat.END) == len(turns)
        marked = [text[m.start:m.end] for m in masks[conv].loss_mask]
        assert len(marked) == sum(r == "assistant" for r, _ in turns)
    assert chat.format_conversations(df.limit(0)).count() == 0


TURNS = [
    (1, 0, "user", "What?"), (1, 1, "assistant", "a long answer, " * 20), (1, 1, "assistant", "b"),
    (1, 1, "assistant", "b"), (1, None, None, None), (2, 0, "assistant", "xé😀"), (None, 3, "tool", "y"),
]


def test_streamed_logs_fold_to_the_same_turns(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    log = chat.as_streamed_events(turns)
    assert {r["op"] for r in log.collect()} == {"message", "delta", "edit", "regenerate"}
    assert log.count() == 6 * len(TURNS)
    shown = [
        {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in
         chat.read_back(chat.format_conversations(events)).collect()}
        for events in (log, chat.as_events(turns))
    ]
    assert shown[0] == shown[1]
    assert shown[0][1] == [("", ""), ("user", "What?"), ("assistant", "a long answer, " * 20),
                           ("assistant", "b"), ("assistant", "b")]


@pytest.mark.parametrize("shape", ["turns", "one slot"])
def test_time_is_linear_in_a_conversation(spark, shape):
    def seconds(n):
        events = spark.range(n).select(
            F.lit(1).alias("conv_id"), (F.lit(0) if shape == "one slot" else F.col("id")).alias("slot"),
            F.col("id").alias("seq"), F.lit("message").alias("op"), F.lit("assistant").alias("role"),
            F.concat(F.lit("some text "), "id").alias("text"),
        )
        start = time.perf_counter()
        row = chat.read_back(chat.format_conversations(events)).select(F.size("turns"), F.length("loss_text")).first()
        assert row[0] == n and row[1] > 10 * n
        return time.perf_counter() - start

    seconds(100)
    small, large = (min(seconds(n) for _ in range(2)) for n in (10_000, 60_000))
    assert large < small * 6 ** 1.3


def test_chat_plan_is_native(spark):
    text = QUERIES["op3_chat_format"](spark, f"{DATA}/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "ExistingRDD" not in text


PAGES = [
    (1, "http://a/", "x" * 1000), (2, "http://b/\r\nX: 1", "x" * 1000), (5, None, "x" * 1000),
    (3, "u", "x" * 999), (4, "u", "x" * 999), (6, "u", None), (7, "u", ""), (None, "u", "x" * 1000),
    (8, "u", "WARC/1.1\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\r\n\r\n"), (9, "u", "é" * 200_000), (9, "u", "é" * 200_000),
    (10, "u", "é" * 200_000), (11, "u", "y" * 65_536), (11, "u", "z" * 2000),
]


@pytest.mark.parametrize("chunk", [65_536, 100])
def test_archives_round_trip(spark, folder, monkeypatch, chunk):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("c"))
    if chunk == 100:
        rows = [r for r in PAGES if len(r[2] or "") < 5000]
        pages = pages.filter("html is null or length(html) < 5000")
    else:
        rows = PAGES
    records = warc.archived(pages.repartition(3), f"file://{folder}/warc")
    chunks = records.collect()
    assert max(len(c.data) for c in chunks) <= warc.CHUNK
    got = sorted(
        (str(r.record), r.bytes, r.sha1, r.type, str(r.refers_to))
        for r in warc.record_summary(records).collect()
    )
    import hashlib

    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = max(same, default=None)
        again = len(data) >= 1000 and page != first
        want.append((
            str(page), len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response",
            str(first if again else None),
        ))
    assert got == sorted(want)
    payloads = {}
    for c in sorted(chunks, key=lambda c: c.chunk):
        if c.type == "response" and c.record not in (9, 11, None):
            payloads[c.record] = payloads.get(c.record, b"") + bytes(c.data)
    assert payloads[8].decode() == PAGES[8][2] and payloads[6] == payloads[7] == b""
    assert all(payloads[p] == h.encode() for p, _, h in rows if p in (3, 4, 5))


def test_small_reads_and_damage(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    out = io.BytesIO()
    import hashlib

    payload = bytes(range(256)) * 3
    digest = hashlib.sha1(payload).hexdigest()
    head = warc._head(5, "u", digest, None, warc.HTTP % len(payload), len(payload))
    for _ in range(2):
        warc._write_record(out, head, memoryview(payload))
    rows = list(warc.chunk_rows(io.BytesIO(out.getvalue())))
    assert b"".join(r[4] for r in rows) == payload * 2
    assert [r[6] for r in rows if r[7]] == [digest] * 2
    assert [r[5] for r in rows if r[7]] == [len(payload)] * 2
    bad = zlib.compressobj(1, zlib.DEFLATED, 31)
    data = bad.compress(head + payload[::-1] + b"\r\n\r\n") + bad.flush()
    with pytest.raises(ValueError, match="damaged"):
        list(warc.chunk_rows(io.BytesIO(data)))
    with pytest.raises(EOFError):
        list(warc.chunk_rows(io.BytesIO(out.getvalue()[:200])))


def test_no_pages_no_archive(spark, folder):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    records = warc.archived(pages, f"file://{folder}/none")
    assert records.count() == 0 and warc.record_summary(records).count() == 0
