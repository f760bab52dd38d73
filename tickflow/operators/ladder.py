"""Mean and deviation over a ladder of tumbling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.moments import FIELDS, deviation, mean_of, slot_moments, spread_around
from tickflow.functions.timeline import floor_to, from_micros, micros, time_type
from tickflow.schemas import LADDER, LATENESS, MICROS, Ladder


def window_stats(ticks: DataFrame, ladder: Ladder = LADDER, lateness: int = LATENESS) -> DataFrame:
    """`timestamp, symbol, window, avg_price, std_price`; timestamp = window end.

    Windows are `[start, end)`, aligned to the epoch, and present only where
    they hold a tick. Null times are dropped; a null symbol is its own group.
    """
    if ticks.isStreaming:
        from tickflow.streaming.ladder import streaming_window_stats
        return streaming_window_stats(ticks, ladder, lateness)
    as_type = time_type(ticks, "timestamp")
    return _stats_by_block(ticks, ladder).select(
        from_micros(F.col("at"), as_type).alias("timestamp"),
        "symbol", "window", "avg_price", "std_price",
    )


def nested_window_stats(ticks: DataFrame, ladder: Ladder = LADDER, lateness: int = LATENESS) -> DataFrame:
    """`nest_stats(window_stats(ticks))` without a further shuffle."""
    if ticks.isStreaming:
        from tickflow.streaming.ladder import streaming_nested_stats
        return streaming_nested_stats(ticks, ladder, lateness)
    as_type = time_type(ticks, "timestamp")
    packed = nest(_stats_by_block(ticks, ladder), "stats", ["window", "avg_price", "std_price"], ladder,
                  keys=("symbol", "block", "at"))
    return packed.select(from_micros(F.col("at"), as_type).alias("timestamp"), "symbol", "stats")


def _stats_by_block(ticks: DataFrame, ladder: Ladder) -> DataFrame:
    table = slots(ticks, ladder)
    if ladder.blocks_are_small:
        return merge_rungs(on_rungs(by_block(table, ladder), ladder))
    return merge_rungs(on_rungs(table.withColumn("block", F.lit(0)), ladder))


def slots(ticks: DataFrame, ladder: Ladder, *extra: Column) -> DataFrame:
    """Moments per symbol and slot, the widest interval that divides all rungs.

    The only step that sees ticks: one scan, one hash update per tick, combined
    before the shuffle, so a hot symbol or a hot slot costs a row per map task.
    `extra` aggregates may use `us` and `slot`.
    """
    return (
        ticks.filter(F.col("timestamp").isNotNull())
        .select("symbol", "price", micros(F.col("timestamp")).alias("us"))
        .withColumn("slot", floor_to(F.col("us"), ladder.slot))
        .groupBy("symbol", "slot")
        .agg(*slot_moments(F.col("price")), *extra)
    )


def by_block(slot_rows: DataFrame, ladder: Ladder) -> DataFrame:
    """Bring all slots of a block together, before they multiply into rungs.

    A block holds at most block / slot rows whatever the number of ticks, and
    every later grouping contains (symbol, block), so this is the last shuffle.
    Where widths hardly nest and blocks would be long, rungs go first instead
    and `merge_rungs` shuffles by window.
    """
    return slot_rows.withColumn("block", floor_to(F.col("slot"), ladder.block)).repartition("symbol", "block")


def rung_entries(ladder: Ladder) -> list[Column]:
    """For a slot: its window on every rung, named by the window's end."""
    return [
        F.struct(
            F.lit(label).alias("window"),
            (floor_to(F.col("slot"), width) + F.lit(width * MICROS)).alias("at"),
        )
        for label, width in ladder.rungs
    ]


def on_rungs(blocks: DataFrame, ladder: Ladder) -> DataFrame:
    return (
        blocks.withColumn("rung", F.explode(F.array(*rung_entries(ladder))))
        .select("symbol", "block", "rung.at", "rung.window", *FIELDS)
    )


def merge_rungs(entries: DataFrame, *carried: str) -> DataFrame:
    """Merge slot moments per window, inside the partitions they are in."""
    keys = ["symbol", "block", "at", "window"]
    whole = Window.partitionBy(*keys)
    known = entries.withColumns({
        "all_n": F.sum("n").over(whole),
        "all_total": F.sum("total").over(whole),
    })
    mean = mean_of(F.col("all_total"), F.col("all_n"))
    merged = known.groupBy(*keys).agg(
        F.first("all_n").alias("n"),
        F.first(mean).alias("avg_price"),
        F.sum(spread_around(mean)).alias("spread"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        *[F.first(c).alias(c) for c in carried],
    )
    return merged.select(
        *keys, "avg_price",
        deviation(F.col("n"), F.col("spread"), F.col("lo"), F.col("hi")).alias("std_price"),
        *carried,
    )


def nest(
    rows: DataFrame, into: str, fields: list[str], ladder: Ladder, keys=("timestamp", "symbol"), named=None,
) -> DataFrame:
    """One row per key with an array of structs, in ladder order; `named` keys are kept.

    A key has at most one row per rung, so the arrays are as short as the ladder.
    """
    order = F.array_position(F.array(*[F.lit(label) for label in ladder.labels]), F.col(fields[0]))
    packed = F.sort_array(F.collect_list(F.struct(order.alias("rank"), *fields)))
    return rows.groupBy(*keys).agg(packed.alias("packed")).select(
        *(named or keys),
        F.transform("packed", lambda p: F.struct(*[p[f].alias(f) for f in fields])).alias(into),
    )


def nest_stats(stats: DataFrame, ladder: Ladder = LADDER) -> DataFrame:
    """`timestamp, symbol, stats`: the wire form of `window_stats` rows."""
    if stats.isStreaming:
        raise ValueError("on a stream use tickflow.streaming.ladder.streaming_nested_stats")
    return nest(stats, "stats", ["window", "avg_price", "std_price"], ladder)


def unnest_stats(nested: DataFrame) -> DataFrame:
    """Back to one row per window; null and empty arrays give no row."""
    return nested.select("timestamp", "symbol", F.explode("stats").alias("s")).select(
        "timestamp", "symbol", "s.window", "s.avg_price", "s.std_price")
