"""A training corpus from raw documents: rules, line dedup, near-duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents. A document that quality rules reject
goes; repeated runs of lines are cut from the later copies; of each group of
near-duplicates the smallest doc_id stays; the mixture takes documents as often
as their source's target says; packing gives each piece of what is left its
place in a sequence.

Null and empty texts are rejected by the first stage. A document that loses all
its lines stays, empty, until its near-duplicates (other empty ones) are
reduced to one, which the mixture takes 0 times. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickflow.llm import line_runs, mixing, packing, quality, simhash
from tickflow.llm.helpers import documents, saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_runs.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack),
]

# Fingerprints, hashed scores and tokens have no counterpart in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
