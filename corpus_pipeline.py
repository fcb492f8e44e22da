"""A corpus pipeline of five stages over ``documents``: language ID, quality rules, exact and near duplicates, packing.

Each stage works on all rows that the one before kept; ``run`` writes each stage's result as Parquet into the
shared folder and reads it again, so a lost executor costs at most the stage that is running. All but the last stage
return the columns of ``documents`` as they are; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bucketloom.llm import exact_dedup, language_id, near_dedup, packing, quality
from bucketloom.llm.common import Tables, ship, table
from bucketloom.llm.queries import vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a letter, or without a main language, go. Learns from the input's own rows that aren't held out."""
    ship(spark)
    return language_id.keep_identified(docs, language_id.learn(docs.where(~language_id.held_out(docs["doc_id"]))))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that fail the base rules or lie outside their language's perplexity band go."""
    ship(spark)
    return quality.keep_good(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the smallest doc_id stays."""
    ship(spark)
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id stays."""
    ship(spark)
    return near_dedup.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    ship(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("best_fit_packing", pack_sequences),
]

#: SQL can express neither the trained models nor the packing; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tables = table(spark, sf_dir, "documents"), Tables(spark)
    for _, stage in STAGES[:-1]:
        docs = tables.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
