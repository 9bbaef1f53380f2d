from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tablehaul.llm import merkle, queries
from tests.parity import DATA, connect, difference

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, idx int, grp long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def rise(nodes):
    """Levels of a plain tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 3]) for i in range(0, len(last), 3)])
    return levels


def path(levels, at):
    for own in levels[:-1]:
        run = at // 3 * 3
        yield own[run:at], own[at + 1:run + 3]
        at //= 3


def plain(rows, tampered):
    """Every column of the manifest, by hand."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = rise([leaf(r) for r in groups[s]])
    top = rise([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for at, row in enumerate(groups[s]):
            steps = [*path(trees[s], at), *path(top, place)]
            value = leaf((*row[:4], row[4].replace("\n", ""))) if tampered(row) else leaf(row)
            for before, after in steps:
                value = h(*before, value, *after)
            proof = h(*[d for step in steps for part in step for d in part])
            root = top[-1][0]
            out.append((row[0], s, leaf(row), trees[s][-1][0], root, proof, value, value == root))
    return out


def rows_of(n):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "en", i, f"text {i}\nof it", "x", 1, 2) for i in range(n)]
    rows += [
        (None, None, None, None, None, None, None, None), (None, "hot", "en", 1, "", "x", 1, 2),
        (5, "hot", "en", 5, "again", "x", 1, 2), (5, "hot", "en", 5, "again", "x", 1, 2),
        (n, "ü", "dé", 3, "é" * 30_000 + "\n", "x", 1, 2), (n + 1, "", "en", 0, "lone", "x", 1, 2),
    ]
    return rows


def odd_id(row):
    return row[0] is not None and row[0] % 2 == 1 and row[4] is not None


def built(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    without = F.replace("text", F.lit("\n"), F.lit(""))
    return merkle.manifest(df, FIELDS, "doc_id", "source", F.col("doc_id") % 2 == 1, {"text": without}, **options)


def key(row):
    return tuple((v is not None, v) for v in row)


@pytest.mark.parametrize("n,levels,slot_rows", [(130, 1, 10), (130, 2, 500), (130, 8, 500), (4, 1, 1)])
def test_manifest_against_a_plain_tree(spark, n, levels, slot_rows):
    rows = rows_of(n)
    got = [tuple(r) for r in built(spark, rows, levels=levels, slot_rows=slot_rows).collect()]
    assert sorted(got, key=key) == sorted(plain(rows, odd_id), key=key)


def test_one_row_and_no_row(spark):
    rows = [(7, None, "en", 2, "a\nb", "x", 1, 2)]
    assert [tuple(r) for r in built(spark, rows).collect()] == plain(rows, odd_id)
    empty = built(spark, [])
    assert empty.columns == ["id", "grp", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert empty.collect() == []


def test_queue_of_a_block_holds_open_runs_only():
    block = merkle.Block(3 ** 7, 7)
    longest = 0
    for at in range(3 ** 7):
        block.leaf(at, str(at))
        longest = max(longest, len(block.queue))
    assert longest <= 2 * 7
    assert block.root == rise([str(i) for i in range(3 ** 7)])[-1][0]


def test_registered_query_agrees_with_sql(spark):
    class Query:
        sql = queries.SQL["op12_merkle_manifest"]

        def __call__(self, spark, folder):
            return queries.QUERIES["op12_merkle_manifest"](spark, folder)

    folder = f"{DATA}/sf0.001"
    assert difference(Query(), spark, connect(folder), folder) is None
