"""Queries of the operators on the corpus as a whole and on its words: Merkle manifest
(11), periodic runs (12), language-model scoring (13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascape.llm import merkle, periodic, ppm
from terrascape.llm.common import table

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, "doc_id", "lang", FIELDS, {"text": merkle.tampered("doc_id", "text")})


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.detect(table(spark, sf_dir, "documents"), plant=True)


def op13_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)


QUERIES = {f.__name__: f for f in (op11_merkle, op12_periodic, op13_ppm)}
ORACLE_SQL = {"op11_merkle": merkle.ORACLE, "op12_periodic": periodic.ORACLE}
