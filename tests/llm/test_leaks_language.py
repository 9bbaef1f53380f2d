import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablehaul.llm import decontaminate, fm_index, langid
from tablehaul.llm.queries import QUERIES
from tests.parity import DATA


@pytest.mark.parametrize("seed", range(6))
def test_fm_index_finds_every_occurrence(seed):
    rng = random.Random(seed)
    sigma = rng.choice([1, 2, 3, 9, 40])
    text = []
    for _ in range(rng.randrange(1, 25)):
        text += [rng.randint(1, sigma) for _ in range(rng.randrange(1, 40))] + [0]
    patterns = np.zeros((30, 4), np.int64)
    for row in patterns:
        n = rng.randint(1, 4)
        row[4 - n:] = [rng.randint(1, sigma) for _ in range(n)]
    index = fm_index.FMIndex(np.array(text), sigma)
    which, at = index.occurrences(patterns)
    want = {
        (i, p) for i, row in enumerate(patterns.tolist()) for p in range(len(text))
        if text[p:p + sum(x > 0 for x in row)] == [x for x in row if x]
    }
    assert len(which) == len(want) and set(zip(which.tolist(), at.tolist())) == want


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_leaks(text, items, window=10):
    words, hit, found = plain_words(text), set(), set()
    for item, own in items:
        own = plain_words(own)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            w = own[i:i + window]
            for p in range(len(words) - len(w) + 1):
                if words[p:p + len(w)] == w:
                    hit |= set(range(p, p + len(w)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


ITEMS = [
    (1, "a b c d e f g h i j k l"), (10, "the cat"), (2, "b c d e f g h i j k"), (3, None), (4, "..."),
    (5, "Éa, x1 y"), (None, "lost words"), (1, "another text of the same item that is longer than ten"),
]
TEXTS = [
    None, "", "A b. c d e f g h i j k l m", "the CAT the cat the", "éa x1 Y", "Éa x1 y\nthe cat",
    "a b c d e f g h i", "lost words", "nothing here", "a b c d e f g h i j " * 400, "the " * 3000 + "cat",
]


@pytest.mark.parametrize("block", [8_000_000, 20])
def test_leaks(spark, docs, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 50)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = docs([*enumerate(TEXTS), (3, TEXTS[3])], n_words="c")
    rows = decontaminate.with_leaks(df, items, out="found").collect()
    assert len(rows) == len(TEXTS) + 1
    named = [("null" if i is None else i, t) for i, t in ITEMS]
    for r in rows:
        words, hit, found = plain_leaks(r.text, named)
        assert (r.found.n_words, list(r.found["items"])) == (words, found)
        assert sum(s.n_words for s in r.found.spans) == hit
        for s in r.found.spans:
            own = plain_words(r.text[s.start:s.end])
            assert own == plain_words(r.text)[s.first_word:s.first_word + s.n_words]
    kept = decontaminate.decontaminated(df, items)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {
        i for i, t in enumerate(TEXTS) if not plain_leaks(t, named)[1]
    }


def test_blocks_of_items_come_one_at_a_time(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 20)
    done, frame = [], type(spark.range(1))
    collect, saved = frame.collect, decontaminate.saved
    monkeypatch.setattr(frame, "collect", lambda df: done.append("collect") or collect(df))
    monkeypatch.setattr(
        decontaminate, "saved", lambda df, name, **o: done.append(name) or saved(df, name, **o)
    )
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    decontaminate.with_leaks(docs([*enumerate(TEXTS)]), items)
    n = done.count("leaks")
    passes = [x for x in done if x in ("collect", "leaks")][-2 * n:]  # the sum comes before
    assert n > 2 and passes == ["collect", "leaks"] * n


def test_leaks_of_nothing(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.with_leaks(docs([]), items).count() == 0
    clean = decontaminate.with_leaks(docs([(1, "the cat")]), items.limit(0), out="x").first()
    assert clean.x.n_words == 2 and not clean.x.spans and not list(clean.x["items"])


def test_leak_query(spark):
    sf = f"{DATA}/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    windows = {}
    for item, text in items:
        own = plain_words(text)
        for i in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(tuple(own[i:i + 10]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    rows = QUERIES["op5_decontamination"](spark, sf).collect()
    assert len(rows) == len(texts) and any(r.contaminated for r in rows)
    for r in rows:
        words, hit, found = plain_words(texts[r.doc_id]), set(), set()
        for n in lengths:
            for p in range(len(words) - n + 1):
                if own := windows.get(tuple(words[p:p + n])):
                    hit |= set(range(p, p + n))
                    found |= own
        want = (len(words), len(hit), len(found), bool(hit))
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == want
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def plain_phrases(text, sample):
    count, at = 0, 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at:at + n + 1] in sample:
            n += 1
        count, at = count + 1, at + n
    return count


@pytest.mark.parametrize("size", [1, 2, 7, 50, 1024])
def test_phrases_are_longest_matches(monkeypatch, size):
    """Blocks and parts change nothing: the phrases are those of whole texts."""
    monkeypatch.setattr(langid, "BLOCK", size)
    rng = random.Random(4)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    samples = {"x": make("abc ", 500), "y": make("cde ", 300), "z": make("ab", 3), "w": "ab" * 200 + "c" * 90}
    parser = langid.CrossParser(samples)
    code = {p: parser.alphabet.encode(t) for p, t in samples.items()}
    texts = [make("abcdef ", rng.randrange(1, 400)) for _ in range(40)] + ["ab" * 150, "c" * 80 + "ab" * 90]
    pieces = [parser.alphabet.encode(t) for t in texts]
    want = [[plain_phrases(p.tobytes(), code[x].tobytes()) for p in pieces] for x in parser.languages]
    assert parser.phrases(pieces)[0].tolist() == want
    for most in (1, 3, 90):
        for j, text in enumerate(texts[-12:], len(texts) - 12):
            total, n = parser._long(text.lower(), most)
            assert n == len(pieces[j]) and total.tolist() == [w[j] for w in want]


def test_numerals_are_no_letters(spark, docs):
    samples = {"en": "the cat and the dog " * 40}
    texts = ["½ ²", "①", "Ⅷ", "٣", "x²", "ª", "ⅷ 12", "\u0301", "_"]
    found = docs([*enumerate(texts)]).select(
        "doc_id", langid.identified(F.col("text"), samples)["lang"].alias("lang"),
        langid.has_letter(F.col("text")).alias("speaks"),
    )
    got = {texts[r.doc_id]: (r.lang, r.speaks) for r in found.collect()}
    assert {t for t in texts if got[t] == ("en", True)} == {"x²", "ª"}
    assert all(got[t] == ("und", False) for t in texts if t not in ("x²", "ª"))


def test_labels_are_bounded_by_frequency(spark):
    rows = [(i, f"text {chr(97 + i % 26)} of {lang}", lang) for i in range(40) for lang in ("aa", "bb", "cc")[:1 + i % 3]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.warns(UserWarning, match="1 rare labels with 13 rows"):
        assert list(langid.samples_of(df, most_labels=2)) == ["aa", "bb"]


def test_samples_of_many_texts_come_from_below_a_threshold(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "concat('word', id, ' here') AS text", "'en' AS lang")
    one, two = (langid.samples_of(df.repartition(n)) for n in (2, 7))
    assert one == two and one["en"].count("here") == langid.SAMPLE_ROWS


def test_every_letter_of_the_samples_has_its_own_code(monkeypatch):
    han, kana = [chr(0x4E00 + 8 * i) for i in range(300)], [chr(0x3048 + 8 * i) for i in range(8)]
    samples = {
        "en": "the cat and the dog sat here " * 9, "zh": "".join(han), "ja": "".join(kana * 5),
        "EL": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ" * 40,
    }
    alphabet = langid.Alphabet(list(samples.values()))
    letters = {c for t in samples.values() for c in t.lower() if c.isalpha()}
    codes = {int(alphabet.codes[ord(c)]) for c in letters}
    assert len(codes) == len(letters) and 0 not in codes
    assert int(alphabet.codes[ord("ж")]) == int(alphabet.codes[ord("é")]) not in codes
    rng = random.Random(5)
    texts = ["".join(rng.choice([*han, "a", "é", " ", "ж"]) for _ in range(60)) for _ in range(30)]
    texts += ["".join(han[100:130]), "".join(kana[2:6]), "λμν", "sat"]
    for common, cells in ((48, 16_000_000), (1, 1), (1000, 16_000_000)):
        monkeypatch.setattr(langid, "COMMON", common)
        monkeypatch.setattr(langid, "TABLE_CELLS", cells)
        parser = langid.CrossParser(samples)
        pieces = [parser.alphabet.encode(t) for t in texts]
        own = {x: "".join(map(chr, parser.alphabet.encode(t))) for x, t in samples.items()}
        want = [[plain_phrases("".join(map(chr, p)), own[x]) for p in pieces] for x in parser.languages]
        assert parser.phrases(pieces)[0].tolist() == want
        assert parser.identify(texts[-4:])[0] == ["zh", "ja", "EL", "en"]


def test_samples_fill_each_language_from_whole_texts(spark):
    make = lambda word, n: " ".join(f"{word}{chr(97 + i * 26 // n)}" for i in range(n))
    rows = [(1, make("long", 20_000), "one")]
    rows += [(2, "copied text " * 20, "hot")] * 150 + [(i, f"rare words {chr(97 + i)}", "hot") for i in range(9)]
    rows += [(7, make("many", 9_000 + i), "many") for i in range(5)]
    rows += [(i, "misspelt label", f"label{i}") for i in range(60)]
    got = langid.samples_of(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(got) == 63 and max(map(len, got.values())) <= langid.LANGUAGE_CHARS
    for lang, word in (("one", "long"), ("many", "many")):
        assert len(got[lang]) > 0.98 * langid.LANGUAGE_CHARS
        assert {f"{word}{chr(97 + i)}" for i in range(26)} <= set(got[lang].split())
    assert got["hot"].count("copied text") == 20
    assert all(f"rare words {chr(97 + i)}" in got["hot"] for i in range(9))
    assert got["label3"].strip() == "misspelt label"


def test_language_of_odd_texts(spark, docs):
    samples = {"en": "the cat and the dog " * 40, "de": "der hund und die katze " * 40}
    texts = [None, "", "123 !?", "the dog", "DER HUND", "語", "the cat " * 60_000, "İ" * 5]
    found = docs([*enumerate(texts), (None, "the cat")]).select(
        "doc_id", langid.identified(F.col("text"), samples).alias("f")
    )
    got = {r.doc_id: r.f for r in found.collect()}
    assert [got[i].lang for i in range(3)] == ["und"] * 3 and got[0].score == 0
    assert (got[3].lang, got[4].lang, got[6].lang, got[None].lang) == ("en", "de", "en", "en")
    assert all(0 <= f.score <= 1 for f in got.values())
    nothing = docs([(1, "text")]).select(langid.identified(F.col("text"), {}).alias("f")).first()
    assert nothing.f.lang == "und"
    assert langid.samples_of(docs([])) == {} == langid.samples_of(docs([(1, None)]))


def test_held_out_accuracy(spark):
    sf = f"{DATA}/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op6_language_id"](spark, sf).join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
