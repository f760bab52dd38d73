"""Count, sum and spread of a price column, in a form that merges.

A slot of ticks is summed up once by built-in aggregates; wider windows are
merged from slots. The spread of a window is the spread inside its slots plus
the squared distances of the slot means to the window mean: no sum of squares,
so nothing cancels at large prices. The deviation is exactly 0 when smallest
and largest price agree, because a z-score tests it against 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ["n", "total", "m2", "lo", "hi"]


def slot_moments(price: Column) -> list[Column]:
    n = F.count(price)
    return [
        n.alias("n"),
        F.sum(price).alias("total"),
        (F.var_pop(price) * n).alias("m2"),
        F.min(price).alias("lo"),
        F.max(price).alias("hi"),
    ]


def mean_of(total: Column, n: Column) -> Column:
    """Mean, null where every price was null."""
    return F.when(n > 0, total / n)


def spread_around(mean: Column) -> Column:
    """Summand of a slot in the spread of a window with this mean."""
    distance = mean_of(F.col("total"), F.col("n")) - mean
    return F.col("m2") + F.col("n") * distance * distance


def deviation(n: Column, spread: Column, lo: Column, hi: Column) -> Column:
    """Sample deviation: null below two prices, 0 for a flat window."""
    flat = (lo == hi) & (F.abs(lo) < F.lit(float("inf")))
    return F.when(n > 1, F.when(flat, F.lit(0.0)).otherwise(F.sqrt(spread / (n - 1))))
