import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tablehaul.llm import tokens
from tests.llm.test_dedup import brute_groups, plain_simhash
from tests.llm.test_leaks_language import plain_words
from tests.parity import DATA

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, stage(spark, docs, SF)
        rows = docs.collect()
        out.append((name, given.columns, given.collect(), docs.columns, rows))
        docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_stages_keep_the_columns(stages):
    assert [s[0] for s in stages] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing",
    ]
    for _, given, _, got, _ in stages[:-1]:
        assert given == got


def test_language_keeps_all_texts_with_letters(stages):
    _, _, given, _, kept = stages[0]
    assert {r.doc_id for r in kept} == {
        r.doc_id for r in given if any(c.isalpha() for c in r.text or "")
    }


def test_language_without_labels_rejects_the_same(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, "12 !?"), (4, "a text"), (5, "語"), (6, "½"), (4, "a text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for samples in ({}, {"en": "the cat and the dog"}):
        monkeypatch.setattr(corpus_pipeline, "language_samples", lambda *_: samples)
        kept = corpus_pipeline.language(spark, docs, SF)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [4, 4, 5]  # a numeral is no letter


def test_exact_duplicates_go(stages):
    _, _, given, _, kept = stages[1]
    last = {}
    for r in given:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in kept) == sorted(last.values()) and len(kept) < len(given)


def test_one_of_each_near_group_stays(stages):
    _, _, given, _, kept = stages[2]
    prints = {r.doc_id: plain_simhash(r.text) for r in given}
    find = brute_groups(list(prints.values()))
    first = {}
    for doc, fp in prints.items():
        first[find(fp)] = min(first.get(find(fp), doc), doc)
    assert sorted(r.doc_id for r in kept) == sorted(first.values())


def test_leaking_documents_go(stages, spark):
    _, _, given, _, kept = stages[3]
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        own = plain_words(r.text)
        windows |= {tuple(own[i:i + 10]) for i in range(max(1, len(own) - 9) if own else 0)}
    lengths = {len(w) for w in windows}

    def leaks(text):
        words = plain_words(text)
        return any(tuple(words[p:p + n]) in windows for n in lengths for p in range(len(words) - n + 1))

    assert {r.doc_id for r in kept} == {r.doc_id for r in given if not leaks(r.text)}
    assert len(kept) < len(given)


def test_packing_holds_all_that_is_left(stages):
    _, _, given, _, pieces = stages[4]
    encoder = tokens.Encoder(corpus_pipeline.TOKENIZER)
    ids = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        ids.setdefault(p.doc_id, []).extend(np.frombuffer(bytes(p.ids), "<u4").tolist())
    assert ids == {r.doc_id: [*encoder.whole(r.text), 1] for r in given}


def test_run_is_registered_and_agrees(stages, spark):
    rows = contract.queries()["pipeline"](spark, SF)
    assert {r.doc_id for r in rows.select("doc_id").collect()} == {r.doc_id for r in stages[4][4]}
    names = [f"op{n}_" for n in range(1, 11)]
    assert all(sum(q.startswith(n) for q in contract.queries()) == 1 for n in names)


def test_odd_rows_pass_through_every_stage(spark):
    rows = [
        (None, None, None, None, None), (1, "", "en", "s", 0), (2, "a cat sat here", "en", "s", 14),
        (2, "a cat sat here", "en", "s", 14), (None, "letters without an id", None, None, None),
        (3, "long " * 50_000, "en", "s", 250_000),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, open string"
    for data in (rows, []):
        docs = spark.createDataFrame([(*r, "x", "y") for r in data], schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        found = {r.doc_id for r in docs.collect()}
        assert found == ({None, 2, 3} if data else set())
