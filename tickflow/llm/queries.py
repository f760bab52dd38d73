"""Registered queries of the operators: whole tables in, whole results out, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickflow.llm import (
    exact_dedup, item_search, licenses, line_runs, mixing, packing, phrases, quality, sharding, simhash, substrings,
    token_counts, token_files,
)
from tickflow.llm.helpers import documents

Query = Callable[[SparkSession, str], DataFrame]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


QUERIES: dict[str, Query] = {
    "op1_mix_sources": lambda spark, d: mixing.mix_report(documents(spark, d)),
    "op2_shard": lambda spark, d: sharding.shard_report(documents(spark, d), shards=8),
    "op3_pack": lambda spark, d: packing.packed(documents(spark, d)),
    "op4_token_counts": lambda spark, d: token_counts.token_counts(documents(spark, d)),
    "op5_exact_dedup": lambda spark, d: exact_dedup.exact_duplicates(documents(spark, d)),
    "op6_quality_rules": lambda spark, d: quality.quality_report(documents(spark, d), _labels(spark, d)),
    "op7_simhash": lambda spark, d: simhash.near_duplicates(documents(spark, d)),
    "op8_substring_dedup": lambda spark, d: substrings.substring_report(documents(spark, d)),
    "op9_license_scan": lambda spark, d: licenses.licence_report(documents(spark, d)),
    "op10_line_dedup": lambda spark, d: line_runs.line_report(documents(spark, d)),
    "op11_item_search": lambda spark, d: item_search.ranked_documents(documents(spark, d), _benchmark(spark, d)),
    "op12_token_files": lambda spark, d: token_files.token_report(documents(spark, d)),
    "op13_phrases": lambda spark, d: phrases.phrases(documents(spark, d)),
}
