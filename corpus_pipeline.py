"""A pipeline over the documents table; each stage's rows are written as Parquet and read by the next.

Stages take (spark, docs, sf_dir). All but the last return the columns of documents. Rows without doc_id
and rows that repeat a doc_id with another text are documents of their own.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.llm import ngram_join, packing, rule_ensemble, secret_scan, shared, substring_dedup
from visitflow.llm.queries import held_out
from visitflow.llm.vocabularies import word_bpe


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts; it learns from the labels that are not held out."""
    return rule_ensemble.accepted(docs, shared.table(spark, sf_dir, "labels"), ~held_out())


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of texts alike in 5-word shingles by 0.8."""
    return ngram_join.without_copies(docs, width=5, percent=80)


def fresh_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words that an earlier one has; those left without words go."""
    kept = substring_dedup.without_repeats(docs, size=50)
    changed = F.col("n_removed") > 0
    return kept.where("n_removed = 0 OR n_removed < n_words").select(
        *[
            F.when(changed, F.col("kept")).otherwise(F.col("row.text")).alias(c) if c == "text"
            else F.when(changed, F.char_length("kept").cast("long")).otherwise(F.col("row.n_chars")).alias(c) if c == "n_chars"
            else F.col(f"row.`{c}`")
            for c in docs.columns
        ]
    )


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each secret that the forest confirms masked; all documents stay."""
    found = shared.stored(secret_scan.scan(docs).where("is_secret"), "secrets")
    return secret_scan.masked(docs, found)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens."""
    return packing.packed(docs, word_bpe(), capacity=4096, end_id=2)


_last: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage whose intermediate tables go when the next stage begins: its rows are written by then."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        shared.ready(spark)
        if spark in _last:
            shared.delete(spark, _last.pop(spark))
        with shared.scratch(spark) as path:
            _last[spark] = path
            return work(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", _stage(good_documents)),
    ("n-gram Jaccard join", _stage(distinct_documents)),
    ("substring dedup", _stage(fresh_passages)),
    ("secret scans", _stage(without_secrets)),
    ("packing", _stage(packed_sequences)),
]

#: Its trained and tokenizing stages have no SQL form; tests/llm compares it with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = shared.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
