import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablehaul.llm import packing, token_histogram, tokens
from tablehaul.llm.queries import QUERIES, TOKENIZER
from tests.parity import DATA

TEXTS = [
    "", " \n ", "a.b", "it's. don't, x's", "!!. ..,", "Ünï. 12. 3,5", "İx Σας ΣΑΣ. K", "é. ́x",
    "\x1cfoo\x1dbar\x85z\x0b\x0c", "x<|endoftext|>. <|startoftext|>", "'s 'S. ''s", "word###,, wörd!!",
    "語 語. ١٢", "İ' İİ'. İ", "\u0958' \u0958\u0958.", "\u0130,x \ufb2a!", "<|STARTOFTEXT|> x<|EndOfText|>", "a" * 500, "many words of one kind " * 2000,
]


def test_remembered_chunks_give_the_tokenizers_ids(monkeypatch):
    encoder = tokens.Encoder(TOKENIZER)
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("ab.,'! éÉ\n1s") for _ in range(40)) for _ in range(500)]
    for most in (800_000, 5):
        monkeypatch.setattr(tokens, "MEMORY", most)
        for own in tokens.bundles(texts, 300):
            for text, ids in zip(own, encoder.packed(own)):
                assert np.frombuffer(ids, "<u4").tolist() == encoder.whole(text), text


def check_packing(pieces, want, window):
    """Each document's ids lie in its pieces once, and sequences are whole or powers of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == window or at & (at - 1) == 0 and at < window
    assert set(by_doc) == set(want)
    for doc, ids in want.items():
        own = sorted(by_doc[doc], key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own[:-1]]]).tolist()
        got = b"".join(bytes(p.ids) for p in own)
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert {p.doc_tokens for p in own} == {len(ids)}
    return by_sequence


@pytest.mark.parametrize("partitions,most_open", [(1, 4), (9, 4), (200, 1)])
def test_packing_keeps_every_token_once(spark, docs, partitions, most_open):
    encoder = tokens.Encoder(TOKENIZER)
    rng = random.Random(partitions)
    texts = TEXTS + [" ".join(rng.choice(["cat", "dogs", "wörd"]) for _ in range(rng.randrange(90))) for _ in range(300)]
    want = {i: [*encoder.whole(t), 1] for i, t in enumerate(texts)} | {1000: [1]}
    df = docs([*enumerate(texts), (1000, None)]).repartition(partitions)
    pieces = packing.pack(df, TOKENIZER, window=64, most_open=most_open).collect()
    short = [s for s in check_packing(pieces, want, 64).values() if sum(p.length for p in s) < 64]
    assert len(short) <= 6


def test_packing_of_nothing(docs):
    assert packing.pack(docs([]), TOKENIZER).count() == 0
    assert [r.doc_id for r in packing.pack(docs([(None, None), (None, "")]), TOKENIZER).collect()] == [None, None]


def test_packing_query(spark):
    sf = f"{DATA}/sf0.001"
    encoder = tokens.Encoder(TOKENIZER)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = {i: np.array([*encoder.whole(t), 1], "<u4") for i, t in texts.items()}
    rows = QUERIES["op2_packing"](spark, sf).collect()
    covered = defaultdict(int)
    for r in rows:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(own.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        covered[r.doc_id] += r.length
    assert covered == {i: len(x) for i, x in ids.items()}


def test_histogram_answers_every_limit(spark, docs, monkeypatch):
    monkeypatch.setattr(token_histogram, "LENGTHS", 4)
    encoder = tokens.Encoder(TOKENIZER)
    rng = random.Random(2)
    texts = [None, "", *(" ".join(["cat"] * rng.randrange(60)) for _ in range(200)), "dog " * 9000]
    lengths = [len(encoder.whole(t or "")) for t in texts]
    histogram = token_histogram.length_histogram(docs(list(enumerate(texts))), TOKENIZER)
    totals = token_histogram.limit_totals(histogram)
    rows = totals.collect()
    assert {r.context_limit for r in rows} == set(lengths)
    for r in rows:
        within = [n for n in lengths if n <= r.context_limit]
        over = [n for n in lengths if n > r.context_limit]
        assert r.n_docs == lengths.count(r.context_limit)
        assert (r.docs_within, r.tokens_within) == (len(within), sum(within))
        assert (r.docs_over, r.tokens_over) == (len(over), sum(over))
        assert r.truncated_tokens == sum(min(n, r.context_limit) for n in lengths)
    for limit in (0, 7, 61, 5000, 10**6):
        got = token_histogram.truncated_total(totals, limit).first()[0]
        assert got == sum(min(n, limit) for n in lengths)
    points = {r.point: r.tokens for r in token_histogram.quantiles(totals, [0.0, 0.5, 0.9, 1.0]).collect()}
    ordered = sorted(lengths)
    for p, n in points.items():
        assert n == ordered[max(0, -int(-p * len(ordered) // 1) - 1)]


def test_histogram_of_nothing(docs):
    totals = token_histogram.limit_totals(token_histogram.length_histogram(docs([]), TOKENIZER))
    assert totals.count() == 0 and token_histogram.truncated_total(totals, 5).first()[0] == 0
    assert token_histogram.quantiles(totals, [0.5]).count() == 0


def test_query_has_other_limits_and_quantiles(spark):
    sf = f"{DATA}/sf0.001"
    encoder = tokens.Encoder(TOKENIZER)
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    lengths = sorted(len(encoder.whole(t)) for t in texts)
    rows = {r.context_limit: r for r in QUERIES["op10_token_counts"](spark, sf).collect()}
    powers = {2 ** n for n in range(21)}
    assert set(rows) == set(lengths) | powers and not powers <= set(lengths)
    for limit, r in rows.items():
        assert r.n_docs == lengths.count(limit)
        assert r.docs_within == sum(n <= limit for n in lengths)
        assert r.truncated_tokens == sum(min(n, limit) for n in lengths)
    points = {p: n for n, r in rows.items() for p in r.quantiles}
    assert len(points) == 11 == sum(len(r.quantiles) for r in rows.values())
    for p, n in points.items():
        assert n == next(x for i, x in enumerate(lengths, 1) if i >= p * len(lengths))


def test_histogram_query(spark):
    sf = f"{DATA}/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert QUERIES["op10_token_counts"](spark, sf).agg(F.sum("n_docs")).first()[0] == n
