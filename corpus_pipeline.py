"""A corpus pipeline: each stage reads what its predecessor wrote, and its decisions take effect.

Run over ``documents``: language identification (texts without a clear language go), exact
de-duplication, near de-duplication by shingles, benchmark decontamination, and packing.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parent)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from casebook.llm import decontaminate, exact_dedup, language, ngram_join, packing  # noqa: E402
from casebook.llm.common import Entry, Scratch, flat, place, table, temporary  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

LEAST_SHARE = 1 / 3  # of a document's letters that its language must have
SHINGLE_WORDS = 5
SIMILARITY = (80, 100)  # near copies share at least 80 of 100 shingles


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those in which no language has a third of the letters."""
    model = language.fit(docs, "text", "lang")
    own = flat(docs)  # columns of the documents may be called like those of the result
    found = language.identify(own, model, text=place(docs, "text"), keep=tuple(own.columns))
    keep = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SHARE)
    return found.where(keep).select(*own.columns).toDF(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.deduplicate(docs, words=SHINGLE_WORDS, similarity=SIMILARITY)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("ngram_join", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # language models, tokenizers and packing are beyond SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over ``documents``; every stage is stored before the next one reads it, and what it kept meanwhile goes."""
    scratch = Scratch(spark, "corpus-pipeline")
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with temporary():
            docs = scratch.store(stage(spark, docs, sf_dir), name)
        scratch.drop(*before)
        before = [name]
    return docs


ENTRIES = {"pipeline": Entry(run, ORACLE_SQL)}
