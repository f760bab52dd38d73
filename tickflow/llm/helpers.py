"""Columns and steps that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickflow.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
_PART_BITS = 33  # of monotonically_increasing_id: the partition is above, the row within it below


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared checkpoint folder; what led to them is not run again."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def same(left: str, right: str, names: Sequence[str]) -> Column:
    """Two aliased tables agree in all named columns, null being equal to null."""
    return reduce(Column.__and__, (F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in names))


def in_order(df: DataFrame, order: Sequence[Column], sums: Sequence[str] = ()) -> DataFrame:
    """Adds `position` (from 0, gapless) in the given order over all rows, and `before_<s>`: the sum of s over all earlier rows.

    Rows are sorted by ranges, so no task holds more than its range, however
    few keys there are; the order should end in columns that tell rows apart.
    Only the row count and sums of each range meet in one place.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = saved(sorted_rows.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_at", _PART_BITS))
    totals = placed.groupBy("_range").agg(
        F.count("*").alias("_rows"), *(F.sum(s).alias(f"_sum_{s}") for s in sums))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first"),
        *(F.coalesce(F.sum(f"_sum_{s}").over(earlier), F.lit(0)).alias(f"_start_{s}") for s in sums))
    # One row per range, so as many as there are shuffle partitions at most.
    out = placed.join(F.broadcast(starts), "_range")
    within = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumns({
        f"before_{s}": F.col(f"_start_{s}") + F.coalesce(F.sum(s).over(within), F.lit(0)) for s in sums})
    inside = F.col("_at") - F.shiftleft(F.col("_range"), _PART_BITS)
    out = out.withColumn("position", F.col("_first") + inside)
    return out.drop("_at", "_range", "_first", *(f"_start_{s}" for s in sums))


def sorted_names(distinct: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """An integer for each row, growing with the order inside each partition of the rows."""
    return distinct.sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id())
