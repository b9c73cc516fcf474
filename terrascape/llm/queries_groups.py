"""Queries of the operators on groups: embeddings (6), packing (7), line dedup (8),
MinHash (10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrascape.llm import embeddings, line_dedup, minhash, packing
from terrascape.llm.common import table


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), pairs=True)


def op7_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer or word_tokenizer())


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (op6_embeddings, op7_packing, op8_line_dedup, op10_minhash)}
ORACLE_SQL = {"op8_line_dedup": line_dedup.WHOLE}
