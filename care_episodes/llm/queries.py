"""The registered queries of the training-data operators, with reference SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from care_episodes.llm import (
    contamination, cover_tree, language, licenses, line_dedup, line_quality, lsh_forest, mixing, page_templates, prefix_trie,
    suffix_dedup, token_alignment,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op9_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


ORACLE["op9_mix_to_weights"] = mixing.ORACLE


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_digest(table(spark, sf_dir, "documents"))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(table(spark, sf_dir, "documents"))


@query
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.deduplicate(table(spark, sf_dir, "documents"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


ORACLE["op2_line_dedup"] = line_dedup.ORACLE


@query
def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_templates.extraction_digest(table(spark, sf_dir, "pages"))


@query
def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_cover_tree_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.linked(table(spark, sf_dir, "embeddings"))


ORACLE["op1_cover_tree_links"] = cover_tree.ORACLE


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE["op11_prefix_trie"] = prefix_trie.ORACLE


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_corpus(table(spark, sf_dir, "documents"))


@query
def op13_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLE["op13_warc_round_trip"] = warc.ORACLE
