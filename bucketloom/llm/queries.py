"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bucketloom.llm import bpe_automaton, exact_dedup, html_text, language_id, line_dedup, near_dedup, packing, quality, sharding, url_filter
from bucketloom.llm.common import ship, table


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file, on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op2_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op3_winnowed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op4_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs.where(~language_id.held_out(docs["doc_id"]))))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents")).drop("row_hash")


def op8_host_suffix_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def _shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_quality_perplexity, op2_histogram_shards, op3_winnowed_lines, op4_bpe_automaton, op5_language_mixture, op6_best_fit_packing, op7_ngram_jaccard, op8_host_suffix_text, op9_exact_dedup, op10_url_filter]
    return {f.__name__: _shipped(f) for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op9_exact_dedup": exact_dedup.ORACLE, "op10_url_filter": url_filter.oracle()}
