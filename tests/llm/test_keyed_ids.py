import gc
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablehaul.llm import byte_ids, keyed_ids, queries, stores
from tablehaul.llm.byte_ids import ByteEncoder, blank_chunks
from tests.parity import DATA

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "bc", "Word", "naïve", " ", "  ", "\n", "\n\n", "\t", ".", "'s", "'", "12", "é", "<|endoftext|>",
    "中文", "\u2009", "\xa0", "·", "Ā", "!?", " \n", "²", "x́", " a", " b.", "\x1c", "\x85", "z" * 70,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("special_text", [False, True])
def test_remembered_words_change_no_id(tokenizer, special_text):
    encoder, rnd = ByteEncoder(PATH, special_text), random.Random(11)
    tokenizer.encode_special_tokens = special_text
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(14))) for _ in range(6000)]
    for at in range(0, len(texts), 200):
        own = texts[at:at + 200]
        for text, ids in zip(own, encoder.packed(own)):
            assert np.frombuffer(ids, encoder.dtype).tolist() == (
                tokenizer.encode(text, add_special_tokens=False).ids
            ), repr(text)
    tokenizer.encode_special_tokens = False


def test_words_beside_line_breaks_are_read_without_patterns_or_collections(tokenizer, monkeypatch):
    encoder, seen, passes = ByteEncoder(PATH), [], []
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdeI", k=rnd.randrange(1, 9))) + rnd.choice(["", "", ".", ",", "\nThe", ".\nIt,"])
             for _ in range(20_000)]
    text = " ".join(words) + " a\n\nb a\n b\n"
    real = encoder.chunk
    monkeypatch.setattr(encoder, "chunk", lambda c, blank: seen.append(c) or real(c, blank))
    watch = lambda phase, info: passes.append(phase)
    gc.callbacks.append(watch)
    try:
        (ids,) = encoder.packed([text])
    finally:
        gc.callbacks.remove(watch)
    assert np.frombuffer(ids, encoder.dtype).tolist() == ids_of(tokenizer, text)[:-1]
    assert len(seen) <= 4 and passes == [] and gc.isenabled()


def test_units_of_any_kind_are_encoded_once(tokenizer, monkeypatch):
    """Chunks with apostrophes, signs or other scripts and runs of white space included."""
    encoder, rnd = ByteEncoder(PATH), random.Random(5)
    parts = ["don't", "ready.\nThen,", "中文", "x́", "été!", "12a", "  if", "\n\n\tb", "·", "\u2009c", "end. \n"]
    texts = [" ".join(rnd.choices(parts, k=30)) for _ in range(50)]
    encoder.packed(texts[:40])
    seen, real = [], encoder.tokenizer
    monkeypatch.setattr(encoder, "whole", lambda text: seen.append(text) or real.encode(text).ids)
    again = encoder.packed(texts[:40][::-1])
    assert seen == []
    assert [np.frombuffer(i, encoder.dtype).tolist() for i in again[::-1] + encoder.packed(texts[40:])] == [
        ids_of(tokenizer, t)[:-1] for t in texts
    ]


@pytest.mark.parametrize("units,block", [(1, 2), (200, 1 << 18), (1 << 20, 7)])
def test_what_is_forgotten_or_long_changes_no_id(tokenizer, monkeypatch, units, block):
    monkeypatch.setattr(byte_ids, "UNITS", units)
    monkeypatch.setattr(byte_ids, "BLOCK", block)
    encoder, rnd = ByteEncoder(PATH), random.Random(6)
    odd = ["'", "’", "٣", "é", "×", "÷", "ɐ", "한", "😀", "\u3000", "\u200b", "\u1680", "\r\n", "\x0b", "\x00", "'ll"]
    pieces = [*PARTS, *odd, "zé" * 40, "word's" * 12]
    for _ in range(20):
        texts = ["".join(rnd.choices(pieces, k=rnd.randrange(14))) for _ in range(60)]
        assert [np.frombuffer(i, encoder.dtype).tolist() for i in encoder.packed(texts)] == [
            ids_of(tokenizer, t)[:-1] for t in texts
        ]
        assert all(len(u) < byte_ids.LONG for u in encoder.units.to_pylist())
    assert encoder.packed([]) == [] and encoder.packed(["", ""]) == [b"", b""]
    (ids,) = encoder.packed(["a  b"], behind=True)
    assert np.frombuffer(ids, encoder.dtype).tolist() == ids_of(tokenizer, " a  b")[:-1]


def test_chunks_join_to_the_text():
    for text in ("", " ", "a", " a", "a b", "a  b", "a \n b", "a b ", "  a   b c"):
        assert " ".join(blank_chunks(text)) == text


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.int64) - (1 << 39)
    index = keyed_ids.PerfectHash.of(keys)
    assert sorted(index.numbers(keys).tolist()) == list(range(n)) and index.size == n


def rows(n=60):
    out = [(i * 7 - 50, f"text {i} has " + "many words " * (i % 9)) for i in range(n)]
    out += [(None, "no key"), (None, None), (13, "twice"), (13, "twice"), (13, "again"), (1 << 62, "")]
    out += [(-(1 << 63), "<|endoftext|> and long " + "ünïcode word " * 5000), ((1 << 63) - 1, None)]
    random.Random(3).shuffle(out)
    return out


def expected(tokenizer, data):
    """In order of keys; texts of one key in any order."""
    want, start = {}, 0
    for key in sorted({k for k, _ in data}, key=lambda k: (k is not None, k or 0)):
        own = [ids_of(tokenizer, t) for k, t in data if k == key]
        want[key] = sorted((len(i), crc(i)) for i in own), start, start + sum(map(len, own))
        start = want[key][2]
    return want


def check(tokenizer, data, found):
    want = expected(tokenizer, data)
    assert len(found) == len(data)
    for key, (own, start, end) in want.items():
        got = sorted((r for r in found if r["key"] == key), key=lambda r: r["start"])
        assert sorted((r["n_tokens"], r["ids_crc32"]) for r in got) == own
        at = start
        for r in got:
            assert r["start"] == at
            at += r["n_tokens"]
            assert len(r["ids"]) == 4 * r["n_tokens"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        assert at == end


@pytest.mark.parametrize("shards", [1, 7])
def test_written_and_read_back(spark, docs, folder, tokenizer, shards):
    data = rows()
    table = docs(data, name="n", start="s", least="m", hash="h")
    manifest = keyed_ids.write_shards(table, PATH, f"{folder}/ids", shards=shards)
    check(tokenizer, data, keyed_ids.read_shards(manifest, f"{folder}/ids").collect())
    held = manifest.agg(F.sum("docs"), F.sum("ids")).first()
    assert tuple(held) == (len(data), sum(len(ids_of(tokenizer, t)) for _, t in data))
    sizes = sum(os.path.getsize(f"{folder}/ids/{f}") for f in os.listdir(f"{folder}/ids") if f.endswith(".ids"))
    assert sizes == 2 * held[1]  # raw ids, two bytes each


def test_keyed_access(spark, docs, folder, tokenizer):
    data = rows()
    manifest = keyed_ids.write_shards(docs(data), PATH, f"{folder}/ids", shards=7)
    whole = keyed_ids.read_shards(manifest, f"{folder}/ids").collect()
    asked = [None, 13, 13, -50, -49, 1 << 62, (1 << 63) - 1, 999]
    keys = spark.createDataFrame([(k, "x") for k in asked], "doc_id long, want string")
    got = keyed_ids.fetch(manifest, f"{folder}/ids", keys, "doc_id").collect()
    assert sorted(got, key=str) == sorted((r for r in whole if r["key"] in asked), key=str)
    none = keyed_ids.fetch(manifest, f"{folder}/ids", keys.limit(0), "doc_id")
    assert none.collect() == []


def test_foreign_keys_are_turned_away(folder):
    store, root = stores.opened(folder)
    writer = keyed_ids.ShardWriter(store, root, np.dtype("<u2"))
    for key in range(0, 4000, 2):
        writer.add(key, b"\1\0\0\0")
    shard = keyed_ids.Shard(store, root, writer.close()[0])
    assert (shard.find(np.arange(1, 4000, 2)) == -1).all()
    assert (shard.find(np.arange(0, 4000, 2)) == np.arange(2000)).all()


def test_empty_table(spark, docs, folder):
    manifest = keyed_ids.write_shards(docs([]), PATH, f"{folder}/ids")
    assert manifest.collect() == []
    assert keyed_ids.read_shards(manifest, f"{folder}/ids").collect() == []


def test_a_damaged_index_is_noticed(spark, docs, folder):
    manifest = keyed_ids.write_shards(docs(rows()), PATH, f"{folder}/ids", shards=1)
    path = f"{folder}/ids/{manifest.first()['name']}.idx"
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-4])
    with pytest.raises(Exception, match="cut off|buffer"):
        keyed_ids.read_shards(manifest, f"{folder}/ids").collect()


def test_registered_query(spark, tokenizer):
    folder = f"{DATA}/sf0.001"
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.QUERIES["op13_keyed_ids"](spark, folder).orderBy("doc_id").collect()
    start = 0
    assert [r["doc_id"] for r in got] == sorted(table)
    for r in got:
        ids = ids_of(tokenizer, table[r["doc_id"]])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


@pytest.mark.parametrize("folder,uri", [
    ("/data/x", "file:///data/x"), ("file:/data/x", "file:///data/x"), ("file:///data/x", "file:///data/x"),
    ("s3a://bucket/x", "s3://bucket/x"), ("s3n://bucket/x", "s3://bucket/x"), ("s3://b/x", "s3://b/x"),
    ("gs://b/x", "gs://b/x"), ("hdfs://host:8020/x", "hdfs://host:8020/x"), ("viewfs://c/x", "viewfs://c/x"),
    ("abfss://c@a.dfs.core.windows.net/x", "abfss://c@a.dfs.core.windows.net/x"),
    ("/odd:name/x", "file:///odd:name/x"),
])
def test_hadoop_schemes(folder, uri):
    assert stores.arrow_uri(folder) == uri


def test_unknown_stores_are_named():
    with pytest.raises(ValueError, match="dbfs"):
        stores.arrow_uri("dbfs:/x")
