"""Record shapes and the window ladder."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import gcd, lcm

from pyspark.sql import types as T

# Wire records, as they travel in a JSON `value` column.
# `from_json` never enforces nullability, so every field is left nullable.
TICK_WIRE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])
WINDOW_STATS_WIRE = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("stats", T.ArrayType(T.StructType([
        T.StructField("window", T.StringType()),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("std_price", T.DoubleType()),
    ]))),
])
ZSCORES_WIRE = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("zscores", T.ArrayType(T.StructType([
        T.StructField("window", T.StringType()),
        T.StructField("zscore_price", T.DoubleType()),
    ]))),
])

# Defaults of the pipeline, in seconds.
LATENESS = 10
PRICE_GRAIN = 1
SHIFT_HORIZON = 20

MICROS = 1_000_000


@dataclass(frozen=True)
class Ladder:
    """Tumbling windows, as label -> width in whole seconds.

    Every window of every rung is a run of whole `slot`s and lies inside one
    `block`, so moments per slot are enough to build all rungs, and a block is
    the unit that has to sit on one task to do it. Where a block has more slots
    than `slots_per_task`, as with widths that hardly nest, batch operators deal
    out windows in place of blocks; results are the same.
    """

    rungs: tuple[tuple[str, int], ...]
    slots_per_task: int = 100_000

    def __post_init__(self):
        widths = [w for _, w in self.rungs]
        if not widths or min(widths) <= 0:
            raise ValueError("a ladder needs at least one rung of positive width")
        if len(set(widths)) != len(widths) or len(set(self.labels)) != len(widths):
            raise ValueError("labels and widths of a ladder must be distinct")

    @classmethod
    def of(cls, **widths: int) -> "Ladder":
        return cls.from_dict(widths)

    @classmethod
    def from_dict(cls, widths: dict[str, int]) -> "Ladder":
        return cls(tuple(sorted(widths.items(), key=lambda rung: rung[1])))

    @property
    def labels(self) -> list[str]:
        return [label for label, _ in self.rungs]

    @property
    def slot(self) -> int:
        return reduce(gcd, (w for _, w in self.rungs))

    @property
    def block(self) -> int:
        return reduce(lcm, (w for _, w in self.rungs))

    @property
    def blocks_are_small(self) -> bool:
        return self.block // self.slot <= self.slots_per_task


# The default ladder, and one for the sparse test events.
LADDER = Ladder.from_dict({
    "30s": 30, "1m": 60, "5m": 300, "15m": 900, "30m": 1800, "1h": 3600,
})
LADDER_SCALED = Ladder.from_dict({
    "6h": 21600, "12h": 43200, "1d": 86400, "2d": 172800, "5d": 432000, "10d": 864000,
})
