"""Z-scores on a stream: ticks joined to the stream of closed windows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickflow.operators.ingest import second_price
from tickflow.operators.zscore import nest_scores, score
from tickflow.schemas import LADDER, LATENESS, PRICE_GRAIN, Ladder


def streaming_scores(
    ticks: DataFrame, stats: DataFrame, grain: int = PRICE_GRAIN, lateness: int = LATENESS,
) -> DataFrame:
    """`score` rows from a stream of ticks and one of unnested window statistics.

    Both sides carry a watermark on the join key, so join state is dropped once
    both have passed it. A score waits for the slower side: the statistics step
    from window end to window end.
    """
    prices = second_price(ticks, grain, lateness)
    return score(prices, stats.withWatermark("timestamp", f"{lateness} seconds"))


def streaming_nested_scores(
    ticks: DataFrame, stats: DataFrame, ladder: Ladder = LADDER, grain: int = PRICE_GRAIN, lateness: int = LATENESS,
) -> DataFrame:
    """The same per (timestamp, symbol) with an array of scores: aggregate, join, aggregate."""
    return nest_scores(streaming_scores(ticks, stats, grain, lateness), ladder)
