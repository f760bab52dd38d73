"""Shards with the mixture of the whole, by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; a row's place is
its fractional rank, (rank + 1/2) / rows of the source, so every source is
spread evenly over the interval. All rows are sorted by that place and cut into
shards of equal row counts (law `rows`: counts differ by one at most), so each
shard holds each source's share, give or take a row.

Both orders are sorts by ranges of narrow rows, so a source with a third of
all rows is ranked by many tasks.

Defined cases: a null text has no bytes and checksum 0; a null source is a
source; rows alike in all columns get neighbouring ranks in any order; shards
may be empty when there are fewer rows than shards; an empty table gives none.
The method has strata (sources) and no groups that must stay together: equal
texts may go to different shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.helpers import in_order, saved

SEED = "shards-1"


def sharded(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text", source: str = "source",
            seed: str = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, text_crc32, shard, slot (from 0, gapless), and the columns to carry."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.struct(*(F.col(c) for c in carry), F.lit(0).alias("_")).alias("carried"))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.col("text_crc32").cast("string")))
    ties = [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id").asc_nulls_last(), F.col("size")]
    ranked = saved(in_order(rows.withColumn("key", key), ties))
    strata = ranked.groupBy(F.col("source").alias("of")).agg(F.min("position").alias("first"), F.count("*").alias("rows"))
    ranked = ranked.join(strata, ranked.source.eqNullSafe(F.col("of")))
    place = (2 * (F.col("position") - F.col("first")) + 1) / (2 * F.col("rows"))
    ranked = ranked.withColumn("place", place).drop("position", "first", "rows", "of")
    placed = saved(in_order(ranked, [F.col("place"), *ties]).drop("place", "key"))
    small, longer = divmod(placed.count(), shards)  # so many shards hold a row more
    head = longer * (small + 1)
    shard = F.when(F.col("position") < head, F.expr(f"position div {small + 1}")).otherwise(
        F.expr(f"{longer} + (position - {head}) div {max(small, 1)}"))
    start = F.col("shard") * small + F.least(F.col("shard"), F.lit(longer))
    out = placed.withColumn("shard", shard.cast("int"))
    return out.select("doc_id", "source", "size", "text_crc32", "shard", (F.col("position") - start).alias("slot"),
                      *(F.col(f"carried.{c}") for c in carry))


def shard_report(docs: DataFrame, **how) -> DataFrame:
    return sharded(docs, **how).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")
