"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``.  The first four return the columns
of ``documents``; a stage's decisions hold for all that follow.

In every stage a null id is a document (MinHash keeps rows with a null id, as no link can
name them), repeated rows are documents of their own until MinHash, where those of equal
ids share one fate, and ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascape.llm import language_id, line_dedup, minhash, packing, toxicity
from terrascape.llm.common import discard, durable, table
from terrascape.llm.queries_groups import word_tokenizer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of no learned language go: null or without a letter, or with hardly an
    n-gram of any."""
    filters = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.keep_identified(docs.select(*COLUMNS), filters)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold go."""
    known = ~language_id.held_out()
    grammar = toxicity.fit(docs.where(known), table(spark, sf_dir, "labels").where(known))
    return toxicity.keep_clean(docs.select(*COLUMNS), grammar)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from the texts; documents stay."""
    cut = line_dedup.dedup(docs.select(*COLUMNS))
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.keep_representatives(docs.select(*COLUMNS)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack_documents(docs, word_tokenizer())


STAGES = [("language", language), ("toxicity", toxic), ("line dedup", lines), ("near duplicates", near_duplicates), ("packing", pack)]
#: SQL cannot express the stages' models; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over ``documents``."""
    docs, old = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
        if old is not None:  # what a stage read goes when its result is written
            discard(old)
        old = docs
    return STAGES[-1][1](spark, docs, sf_dir)
