"""Score the price at a window boundary against the windows that just closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.moments import FIELDS
from tickflow.functions.timeline import floor_to, from_micros, time_type
from tickflow.operators.ingest import second_price
from tickflow.operators.ladder import merge_rungs, nest, rung_entries, slots, window_stats
from tickflow.schemas import LADDER, MICROS, PRICE_GRAIN, Ladder

COLUMNS = ["timestamp", "symbol", "window", "price", "avg_price", "std_price", "zscore_price"]


def zscore() -> Column:
    """0 for a flat or single-tick window (tested first), else distance in deviations."""
    std = F.col("std_price")
    return F.when(std.isNull() | (std == 0), F.lit(0.0)).otherwise(
        (F.col("price") - F.col("avg_price")) / std)


def score(prices: DataFrame, stats: DataFrame) -> DataFrame:
    """Join stored or streamed statistics to per-second prices and score them.

    Inner join on (timestamp, symbol): only seconds in which a window ends, and
    only if they hold a tick, give rows; null keys never match.
    """
    return (
        prices.join(stats, ["timestamp", "symbol"])
        .withColumn("zscore_price", zscore())
        .select(*COLUMNS)
    )


def zscores(ticks: DataFrame, ladder: Ladder = LADDER, grain: int = PRICE_GRAIN) -> DataFrame:
    """`score(second_price(ticks), window_stats(ticks))` in one scan of the ticks.

    Windows end where a slot starts, so the price that is scored is the mean of
    the first `grain` seconds of a slot and comes out of the same aggregate as
    the slot's moments. It then sits beside the windows it belongs to without a
    join: the price at T goes to the block whose windows end at T.
    """
    if ticks.isStreaming:
        raise ValueError("on a stream join second_price and unnested statistics with score")
    if ladder.slot % grain or not ladder.blocks_are_small:
        return score(second_price(ticks, grain), window_stats(ticks, ladder))
    as_type = time_type(ticks, "timestamp")
    return _scored_blocks(ticks, ladder, grain).select(
        from_micros(F.col("at"), as_type).alias("timestamp"), *COLUMNS[1:])


def nested_zscores(ticks: DataFrame, ladder: Ladder = LADDER, grain: int = PRICE_GRAIN) -> DataFrame:
    """`nest_scores(zscores(ticks))` without a further shuffle."""
    if ladder.slot % grain or not ladder.blocks_are_small:
        return nest_scores(zscores(ticks, ladder, grain), ladder)
    as_type = time_type(ticks, "timestamp")
    packed = nest(_scored_blocks(ticks, ladder, grain), "zscores", ["window", "zscore_price"], ladder,
                  keys=("symbol", "block", "at"))
    return packed.select(from_micros(F.col("at"), as_type).alias("timestamp"), "symbol", "zscores")


def _scored_blocks(ticks: DataFrame, ladder: Ladder, grain: int) -> DataFrame:
    opening = floor_to(F.col("us"), grain) == F.col("slot")
    table = slots(
        ticks.filter(F.col("symbol").isNotNull()), ladder,
        F.max(opening).alias("opened"),
        F.avg(F.when(opening, F.col("price"))).alias("open_price"),
    )
    # A slot that opens a block also sends its price to the block before.
    block = floor_to(F.col("slot"), ladder.block)
    opens_block = F.col("opened") & (F.col("slot") == block)
    before = block - F.lit(ladder.block * MICROS)
    blocks = (
        table.withColumn("block", F.explode(F.when(opens_block, F.array(block, before)).otherwise(F.array(block))))
        .repartition("symbol", "block")
    )
    # Entries at the same `at`: one per rung, and the price (no window) if there is one.
    at_home = floor_to(F.col("slot"), ladder.block) == F.col("block")
    price_here = F.col("opened") & (F.col("slot") > F.col("block"))
    price_entry = F.struct(F.lit(None).cast("string").alias("window"), F.col("slot").alias("at"))
    entries = [F.when(at_home, rung) for rung in rung_entries(ladder)] + [F.when(price_here, price_entry)]
    rows = blocks.withColumn("entry", F.explode(F.array(*entries))).filter(F.col("entry").isNotNull()).select(
        "symbol", "block", "entry.at", "entry.window", *FIELDS,
        F.when(F.col("entry.window").isNull(), F.col("open_price")).alias("price"),
        F.col("entry.window").isNull().alias("is_price"),
    )
    # Sorted by the keys of the merge that follows, so both share one sort.
    together = (
        Window.partitionBy("symbol", "block", "at").orderBy("window")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    priced = (
        rows.withColumn("scored", F.max("is_price").over(together))
        .withColumn("price", F.max("price").over(together))
        .filter(F.col("scored") & ~F.col("is_price"))
    )
    return merge_rungs(priced, "price").withColumn("zscore_price", zscore())


def nest_scores(scores: DataFrame, ladder: Ladder = LADDER) -> DataFrame:
    """`timestamp, symbol, zscores`: the wire form."""
    return nest(scores, "zscores", ["window", "zscore_price"], ladder)


def unnest_scores(nested: DataFrame) -> DataFrame:
    """One row per window: `timestamp, symbol, window, zscore_price`."""
    return nested.select("timestamp", "symbol", F.explode("zscores").alias("z")).select(
        "timestamp", "symbol", "z.window", "z.zscore_price")
