import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tablehaul.llm import alignment, queries
from tests.parity import DATA

A_FILE, B_FILE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def plain():
    """Groups of a text by hand: [(A ids, B ids)], encoded whole."""
    a, b = Tokenizer.from_file(A_FILE), SentencePieceProcessor(model_file=B_FILE)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(c): c for c in shown}
    letters |= {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}
    names = {i: t for t, i in a.get_vocab().items()}

    def a_bytes(i):
        return bytes(letters[c] for c in names[i])

    def b_bytes(i):
        if b.is_byte(i):
            return bytes([int(b.id_to_piece(i)[3:-1], 16)])
        return b.id_to_piece(i).replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        whole = f" {text}".encode()
        sides = [
            [(i, a_bytes(i)) for i in a.encode(f" {text}", add_special_tokens=False).ids],
            [(i, b_bytes(i)) for i in b.encode(text)],
        ]
        if any(b"".join(x for _, x in side) != whole for side in sides):
            return []
        ends = []
        for side in sides:
            at, own = 0, {}
            for i, x in side:
                at += len(x)
                own[at] = i
            ends.append(own)
        out, own = [], ([], [])
        for at in sorted(ends[0].keys() | ends[1].keys()):
            for side in (0, 1):
                if at in ends[side]:
                    own[side].append(ends[side][at])
            if at in ends[0] and at in ends[1]:
                out.append(own)
                own = ([], [])
        return out

    return groups


def by_hand(plain, rows):
    found = [(i, plain(t)) for i, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in found]
    count = Counter(pair for own in links for pair in own)
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (i, g), own in zip(found, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((
            i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()),
            sum(n for p, n in own.items() if count[p] == most[p[0]]),
            sum(n * count[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


PARTS = [
    "a", "bc", "Word", "naïve", " ", "  ", "\n", "\n\n", "\t", ".", "'s", "'", "12", "é", "<|endoftext|>",
    "</s>", "中文", " ", "\xa0", "Ā", "!?", " \n", "²", "x́", " a", " b.", "\x1c", "z" * 70,
    "unbelievable", " tokenization,", "😀😀", "10.5", "<0x0A>",
]


def texts_at_random(n, seed=5):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(1, 14))) for _ in range(n)]


def test_words_stand_for_themselves(plain):
    aligner, texts = alignment.Aligner(A_FILE, B_FILE), texts_at_random(3000)
    assert aligner.by_chunk and aligner.by_word
    for at in range(0, len(texts), 100):
        own = texts[at:at + 100]
        rows, place, pair, links = aligner.figures(own)
        for i, (text, row) in enumerate(zip(own, rows)):
            [want] = by_hand(plain, [(i, text)])
            assert row == (*want[1:5], want[7]), repr(text)
            counted = Counter((x, y) for a, b in plain(text) for x in a for y in b)
            mine = {(int(p) // alignment.SIDE, int(p) % alignment.SIDE): int(n)
                    for t, p, n in zip(place, pair, links) if t == i}
            assert mine == dict(counted), repr(text)


@pytest.mark.parametrize("run_chars,radix,fan_in", [(8_000_000, 64, 64), (60, 3, 2), (400, 64, 3)])
def test_counts_against_plain_python(spark, docs, plain, run_chars, radix, fan_in):
    rows = list(enumerate(texts_at_random(150, 9)))
    rows += [(None, "no id here"), (3, "again and again"), (3, "again and again"), (900, None), (901, "")]
    rows += [(902, "piece mark ▁ inside"), (903, "a very long text, " * 3000 + "ünï " * 500), (904, " ")]
    table = docs(rows, run="r", place="p", radix="x", head="h", body="b")
    got = alignment.aligned(table, A_FILE, B_FILE, run_chars=run_chars, radix=radix, fan_in=fan_in)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(by_hand(plain, rows), key=key)


def test_empty_tables(spark, docs):
    assert alignment.aligned(docs([]), A_FILE, B_FILE).collect() == []
    none = alignment.aligned(docs([(1, None), (2, "")]), A_FILE, B_FILE).orderBy("doc_id").collect()
    assert [tuple(r) for r in none] == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_heads_merge_and_squeeze():
    rnd = np.random.default_rng(1)
    heads, want = [], Counter()
    for _ in range(9):
        pairs = np.unique(rnd.integers(0, 1 << 40, 50) // (1 << 34))
        counts = rnd.integers(1, 1000, len(pairs))
        want.update(dict(zip(pairs.tolist(), counts.tolist())))
        heads.append(alignment.head_of(alignment.head(pairs, counts)))
    pairs, counts = alignment.merged(heads)
    assert dict(zip(pairs.tolist(), counts.tolist())) == dict(want) and (np.diff(pairs) > 0).all()
    big = np.array([0, 1 << 40, 3], np.int64)
    assert [x.tolist() for x in alignment.unsqueezed(alignment.squeezed(big, big[:0]))] == [big.tolist(), []]


def test_best_pairs_include_ties():
    pairs = np.array([1 * alignment.SIDE + b for b in (1, 2, 3)] + [5 * alignment.SIDE], np.int64)
    assert alignment.best_of(pairs, np.array([4, 2, 4, 1])).tolist() == [True, False, True, True]


def test_registered_query(spark, plain):
    folder = f"{DATA}/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_alignment"](spark, folder)
    assert got.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    ]
    assert sorted(map(tuple, got.collect())) == sorted(by_hand(plain, rows))
