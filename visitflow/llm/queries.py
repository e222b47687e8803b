"""Registered queries of the corpus operators, each over its whole table, and their SQL where it exists."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.llm import (
    byte_bpe,
    fingerprints,
    id_files,
    lexical_search,
    ngram_join,
    packing,
    periodic_runs,
    projection_forest,
    quality_rules,
    rule_ensemble,
    secret_scan,
    shared,
    sharding,
    substring_dedup,
)
from visitflow.llm.vocabularies import multi_bpe, split_pattern, word_bpe


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(shared.documents(spark, sf_dir), width=3, percent=90)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = shared.documents(spark, sf_dir), shared.table(spark, sf_dir, "labels")
    return quality_rules.judged(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(shared.documents(spark, sf_dir))
    return found.select(
        "doc_id", "word_index", "part", F.sha2("candidate", 256).alias("candidate_sha256"), "label", "score", "is_secret"
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(shared.documents(spark, sf_dir), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.documents(spark, sf_dir)
    folder = f"{shared.folder(spark)}/corpus-{uuid.uuid4().hex}"
    id_files.write(docs, word_bpe(), folder, end_id=2)
    return id_files.read(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.documents(spark, sf_dir).select("doc_id", "text")
    return substring_dedup.without_repeats(docs, size=50, joined=True).select(
        "row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def held_out() -> Column:
    """Rows whose labels no fit may use."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = rule_ensemble.scored(shared.documents(spark, sf_dir), shared.table(spark, sf_dir, "labels"), ~held_out())
    return scores.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(shared.documents(spark, sf_dir), word_bpe(), capacity=4096, end_id=2)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = byte_bpe.round_trip(shared.documents(spark, sf_dir), multi_bpe(), split_pattern())
    return both.select(
        "doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared_with_edits(shared.documents(spark, sf_dir))


def op11_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_forest.near_groups(shared.table(spark, sf_dir, "embeddings"), cosine=0.9)


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, made periodic from some word on in a tenth of the documents; rows without doc_id stay."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.found_runs(shared.documents(spark, sf_dir), power=4, least=6, edit=planted)
    return periodic_runs.digests(found)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.best_documents(shared.documents(spark, sf_dir), shared.table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_quality_rules": op2_quality_rules,
    "op3_secret_scan": op3_secret_scan,
    "op4_sharding": op4_sharding,
    "op5_token_files": op5_token_files,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_packing": op8_packing,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_fingerprints": op10_fingerprints,
    "op11_projection_forest": op11_projection_forest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": ngram_join.ORACLE_SQL,
    "op4_sharding": sharding.ORACLE_SQL,
    "op6_substring_dedup": substring_dedup.ORACLE_SQL,
    "op11_projection_forest": projection_forest.ORACLE_SQL,
    "op13_lexical_search": lexical_search.ORACLE_SQL,
}
