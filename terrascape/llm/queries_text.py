"""Queries of the operators on single texts: SentencePiece (3), sharding (4),
fingerprints (5), toxicity (2) and language identification (9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascape.llm import fingerprints, language_id, sentencepiece_bpe, sharding, toxicity
from terrascape.llm.common import table


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grammar = toxicity.fit(docs.where(~language_id.held_out()), labels.where(~language_id.held_out()))
    scored = toxicity.score(docs, grammar)
    return scored.select("doc_id", language_id.held_out().alias("held_out"), "score", "predicted")


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_bpe.digests(table(spark, sf_dir, "documents"), model)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.assign(rows, "doc_id", 40)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = language_id.fit(docs.where(~language_id.held_out()))
    found = language_id.identify(docs, filters)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "coverage")


QUERIES = {f.__name__: f for f in (op2_toxicity, op3_sentencepiece, op4_sharding, op5_fingerprints, op9_language_id)}
ORACLE_SQL: dict[str, str] = {}
