"""Corpus preparation: language, exact and near duplicates, benchmark leaks, packing.

Every stage takes what the one before kept, written as Parquet and read again. All stages but
the last return the columns of the documents; none of their decisions is only a mark.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.llm import decontaminate, exact_dedup, langid, packing, simhash
from tablehaul.llm.common import ready, table
from tablehaul.llm.queries import language_samples
from tablehaul.session import saved

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in which a language can be told: NULL texts and texts without a letter go,
    whether or not there are labelled rows to learn languages from."""
    ready(spark)
    samples = language_samples(spark, sf_dir)
    if not samples:
        return docs.filter(langid.has_letter(F.col("text")))
    found = langid.identified(F.col("text"), samples)
    return docs.filter(found["lang"] != langid.UNDETERMINED)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of equal texts the document with the largest id."""
    ready(spark)
    return exact_dedup.exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of linked fingerprints."""
    ready(spark)
    return simhash.near_dedup(docs, shingle=3, radius=2)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in which no window of a benchmark item occurs."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece of a document, with its ids."""
    ready(spark)
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("packing", packed),
]

#: SQL can express neither cross-parsing nor a tokenizer; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of a data folder."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
