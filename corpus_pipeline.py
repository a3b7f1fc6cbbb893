"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurecast.llm import jaccard, language, quality, secrets
from tenurecast.llm import packing as best_fit
from tenurecast.llm.common import fold, table
from tenurecast.session import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence."""
    learned = docs.filter(fold("doc_id", 5) != 0)
    model = language.fit(learned)
    marks = ("_language", "_score", "_rejected")
    found = language.identify(docs, model, out=marks)
    return found.filter(~F.col("_rejected")).drop(*marks)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and the learned rules."""
    rules = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.keep(docs, rules)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of every group of near copies (five words, 0.8)."""
    found = jaccard.near_duplicates(docs, width=5, num=4, den=5)
    first = found.filter(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))).select("doc_id").distinct()
    kept = docs.join(first, docs["doc_id"].eqNullSafe(first["doc_id"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found replaced by its kind."""
    return secrets.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in training sequences."""
    return best_fit.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Learned stages and token packing have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before kept; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
