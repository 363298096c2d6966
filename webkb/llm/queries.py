"""Queries of the training-data operators: each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from webkb.llm import (
    arc, audit, decontam, fim, mixing, oracles, order_minhash, pivots, quality, simhash, substrings, suffix_tree,
    token_counts, toxicity)
from webkb.llm.common import read


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.histogram(read(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(read(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(read(spark, sf_dir, "documents"))


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(read(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.archive_pages(read(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_pivot_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(read(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {
        "op1_decontamination": op1_decontamination,
        "op2_quality": op2_quality,
        "op3_token_histogram": op3_token_histogram,
        "op4_mixing": op4_mixing,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_toxicity": op6_toxicity,
        "op7_order_minhash": op7_order_minhash,
        "op8_suffix_tree": op8_suffix_tree,
        "op9_simhash": op9_simhash,
        "op10_arc_to_warc": op10_arc_to_warc,
        "op11_filter_audit": op11_filter_audit,
        "op12_pivot_neighbours": op12_pivot_neighbours,
        "op13_fill_in_middle": op13_fill_in_middle,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {
        "op1_decontamination": oracles.DECONTAMINATION,
        "op5_substring_dedup": oracles.SUBSTRINGS,
        "op10_arc_to_warc": oracles.ARCHIVES,
        "op11_filter_audit": oracles.FILTER_AUDIT,
        "op13_fill_in_middle": oracles.FILL_IN_MIDDLE,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {k: v for k, v in found.items() if v}
