"""Queries of the training-data operators: thin reports over the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from designlab.llm import (bpe, conversations, digest_index, hard_negatives, impact_index, jaccard, langid, packing, quality,
                           substring, suffixes, toxicity, url_rules)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the rule list, else of the mined rules, for every page."""
    return url_rules.filter_urls(_table(spark, sf_dir, "pages"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.report(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document outside 200-byte strings that occur again."""
    return suffixes.report(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and cascade verdict of every document."""
    return quality.quality_report(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of every document through a digest index."""
    return digest_index.op6_report(_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat an earlier document's 13-word windows, removed."""
    return substring.report(_table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and the decoded text of every document."""
    return bpe.op8_report(_table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document."""
    return jaccard.join(_table(spark, sf_dir, "documents"))


def op9_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count, number of linked documents and component of every document, from all links."""
    return jaccard.link_report(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in cost-balanced sequences."""
    return packing.op10_report(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    return hard_negatives.op11_report(_table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation."""
    return conversations.op12_report(_table(spark, sf_dir, "conversations"))


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest inner products of every query vector."""
    return impact_index.op13_report(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_rules, op2_language, op3_toxicity, op4_suffix_dedup, op5_quality_rules,
                            op6_exact_dedup, op7_substring_dedup, op8_bpe, op9_jaccard_join, op9_jaccard_links, op10_packing,
                            op11_hard_negatives, op12_conversation_repair, op13_topk_search)}
SQL = {"op5_quality_rules": quality.OP5_SQL.strip(), "op6_exact_dedup": digest_index.OP6_SQL.strip(),
       "op7_substring_dedup": substring.OP7_SQL.strip(), "op9_jaccard_join": jaccard.OP9_SQL.strip(),
       "op9_jaccard_links": jaccard.OP9_LINKS_SQL.strip(), "op11_hard_negatives": hard_negatives.OP11_SQL.strip(),
       "op13_topk_search": impact_index.OP13_SQL.strip()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
