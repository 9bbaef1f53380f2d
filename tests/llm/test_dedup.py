import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tablehaul.llm import components, exact_dedup, simhash
from tablehaul.llm.queries import QUERIES
from tests.parity import DATA

ROWS = [
    (1, "same"), (2, "same"), (9, "same"), (3, None), (4, ""), (5, "other"), (5, "other"),
    (None, "same"), (None, "lonely"), (6, "x" * 200_000), (7, "x" * 200_000), (8, " same"),
]


def test_exact_groups(docs):
    got = [
        (r.id, r.keep_id, r.group_size, bytes(r.digest))
        for r in exact_dedup.document_groups(docs(ROWS)).collect()
    ]
    groups = {}
    for i, t in ROWS:
        groups.setdefault(t or "", []).append(i)
    want = [
        (i, max((x for x in groups[t or ""] if x is not None), default=None),
         len(groups[t or ""]), hashlib.sha256((t or "").encode()).digest())
        for i, t in ROWS
    ]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_exact_dedup_keeps_one_row_of_each_text_and_all_columns(docs):
    df = docs(ROWS)
    kept = exact_dedup.exact_dedup(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id or 0, (r.text or "")[:9]) for r in kept.collect())
    assert got == [(0, "lonely"), (4, ""), (5, "other"), (7, "x" * 9), (8, " same"), (9, "same")]


def test_exact_dedup_of_nothing(docs):
    assert exact_dedup.exact_dedup(docs([])).count() == 0
    assert exact_dedup.document_groups(docs([])).count() == 0


def test_frequent_digests_are_found_and_ordinary_ones_need_not_be(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("text"), "id"
    )
    keyed = exact_dedup.digests(rows, F.col("id"))
    hot = spark.range(1).select(F.xxhash64(F.unhex(F.sha2(F.lit("0"), 256)))).first()[0]
    found = [r.item for r in exact_dedup.frequent(keyed).collect()]
    assert hot in found and len(found) <= exact_dedup.SHARDS * exact_dedup.TOP
    sizes = exact_dedup.exact_groups(keyed).groupBy("group_size").count().collect()
    assert {(r.group_size, r["count"]) for r in sizes} == {(6667, 6667), (1, 13333)}


def plain_simhash(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, own = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [own] if own else []
            own = ""
        else:
            own += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [
    None, "", " \n\t", "one", "One TWO", "a b c", "a b c d A B C D", "É é\xa0x\x1cy  z\x0bq", "w " * 5000,
])
def test_fingerprint(text):
    assert simhash.simhash(text) % 2**64 == plain_simhash(text)


def test_fingerprint_hash_is_sparks_own(spark):
    h = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert simhash.simhash("a b c") == h


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_within_the_radius(radius):
    rng = random.Random(5)
    fixed = {0: 0}
    for level in simhash.mask_levels(radius, 2):
        by_parent = {}
        for parent, table, mask in level:
            by_parent.setdefault(parent, []).append((table, mask))
        for parent, masks in by_parent.items():
            free = [b for b in range(64) if not fixed[parent] >> b & 1]
            for _ in range(200):
                flips = sum(1 << b for b in rng.sample(free, radius))
                assert any(not m & flips for _, m in masks)
        fixed = {table: mask for _, table, mask in level}


def brute_groups(prints):
    fps = sorted(set(prints))
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) % 2**64).bit_count() <= 2:
                root[find(a)] = find(b)
    return find


@pytest.mark.parametrize("bucket", [2, 16])
def test_near_groups_lose_no_link(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(bucket)
    prints = [rng.getrandbits(64) - 2**63 for _ in range(40)] + [0, 0, -1, 1, 3]
    for f in list(prints[:8]):
        for _ in range(30):  # dense balls: many fingerprints that agree on most masks
            for b in rng.sample(range(64), rng.choice([1, 2, 3])):
                f = simhash._signed((f ^ (1 << b)) % 2**64)
            prints.append(f)
    df = spark.createDataFrame(list(enumerate(prints)), "id long, fp long")
    got = {(r.fp, r.root, r.least_id) for r in simhash.near_groups(df).collect()}
    find = brute_groups(prints)
    classes = {}
    for i, f in enumerate(prints):
        classes.setdefault(find(f), []).append((f, i))
    want = {
        (f, min(x for x, _ in own), min(i for _, i in own)) for own in classes.values() for f, _ in own
    }
    assert got == want


def test_near_dedup(docs):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [
        (5, long), (3, long + " tail"), (4, "quite different text"), (None, long), (1, None), (2, " "),
        (4, "quite different text"),
    ]
    df = docs(rows)
    marks = simhash.near_duplicates(df).collect()
    assert len(marks) == len(rows)
    assert {r.least_id for r in marks if r.fp == 0} == {1}
    kept = simhash.near_dedup(df)
    assert kept.columns == df.columns
    got = sorted(r.doc_id for r in kept.collect())
    linked = (simhash.simhash(rows[0][1]) ^ simhash.simhash(rows[1][1])) % 2**64
    assert got == ([1, 3, 4] if linked.bit_count() <= 2 else [1, 3, 4, 5])
    assert simhash.near_dedup(docs([])).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 9), (7, 7), *((100, 101 + i) for i in range(50))]
    edges += [(200 + i, 201 + i) for i in range(40)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, 100: 100}
    want |= {101 + i: 100 for i in range(50)} | {200 + i: 200 for i in range(41)}
    assert got == want
    assert components.connected_components(df.limit(0)).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_simhash_query_against_all_pairs(spark, sf):
    folder = f"{DATA}/{sf}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    least = {i: i for i in texts}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash"](spark, folder).collect()}
    assert got == {i: (f"{prints[i]:016x}", find(i)) for i in ids}
    assert any(find(i) != i for i in ids)
