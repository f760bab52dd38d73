"""How long after each tick its symbol first traded higher, and first lower.

A later tick counts if it is strictly later and at most `horizon` whole seconds
elapsed, so up to `horizon` + 0.999999 s.

Ticks are sorted by ranges of (symbol, time) into pieces of about equal size,
whatever the symbols and instants they are crowded into. Each task walks its
piece once, from the latest tick to the earliest (`functions.beyond`), and
answers nearly all. What is left open at the end of a piece goes to exactly one
later piece: the first whose highest (or lowest) price beats it, which
`operators.edges` finds in a table of a row per piece. No pairs are formed, no
symbol is held together, and ticks are copied at the edges of pieces only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.timeline import iso_instant, micros, require_utc, time_type
from tickflow.operators import edges
from tickflow.schemas import MICROS, SHIFT_HORIZON

HIGHER = "higher"
LOWER = "lower"


def price_shifts(ticks: DataFrame, horizon: int = SHIFT_HORIZON, pieces: int | None = None) -> DataFrame:
    """All columns of `ticks` plus `higher_window, higher_found, lower_window, lower_found`.

    A window is in seconds, cut to whole milliseconds, and `horizon` where
    nothing was found. Ticks without price or time are dropped; every other
    tick gives one row, copies included.

    `pieces` is the number of ranges, the session's shuffle partitions if not
    given. It changes how the work is cut, never the result.
    """
    if ticks.isStreaming:
        raise ValueError("on a stream use tickflow.streaming.shifts.streaming_price_shifts")
    limit = (horizon + 1) * MICROS
    settled, placed = placement(ticks, limit, pieces)
    found = settled.unionByName(edges.answered(placed, ticks.columns, limit))
    return found.select(*ticks.columns, *_windows("_higher", HIGHER, horizon), *_windows("_lower", LOWER, horizon))


def placement(ticks: DataFrame, limit: int, pieces: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Ticks with both answers, and rows placed for what is left open at the edges of pieces."""
    ranged = _ranged(ticks, pieces)
    settled = edges.walked(ranged, ticks.columns, limit, edge=False)
    routes = edges.routes(edges.ends(ranged), limit)
    return settled, edges.placed(edges.walked(ranged, ticks.columns, limit, edge=True), ticks.columns, routes)


def _ranged(ticks: DataFrame, pieces: int | None) -> DataFrame:
    """Ticks in pieces by (symbol, time), each piece from its last tick to its first.

    All that follows reads the same pieces, that is, the one shuffle below,
    which Spark plans once and uses again: nothing may be pruned or pushed
    between it and the Arrow functions, and nothing is, as these take all
    columns. Ticks of one instant are told apart by their contents, exact
    copies by the partition they came from.
    """
    spark = ticks.sparkSession
    if spark.conf.get("spark.sql.exchange.reuse") != "true":
        raise ValueError("price shifts read one shuffle several times: set spark.sql.exchange.reuse to true")
    time_type(ticks, "timestamp")
    hashed = [f.name for f in ticks.schema if not _has_no_hash(f.dataType)]
    timed = ticks.filter(F.col("price").isNotNull() & F.col("timestamp").isNotNull()).withColumns({
        "_us": micros(F.col("timestamp")), "_tie": F.xxhash64(*hashed, F.spark_partition_id())})
    count = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return timed.repartitionByRange(count, "symbol", "_us", "_tie").sortWithinPartitions(
        F.col("symbol").desc_nulls_last(), F.col("_us").desc(), F.col("_tie")).withColumn("_piece", F.spark_partition_id())


def _has_no_hash(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_no_hash(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_no_hash(f.dataType) for f in kind)
    return isinstance(kind, (T.MapType, T.VariantType))


def _windows(distance: str, kind: str, horizon: int) -> list[Column]:
    return [
        shift_seconds(F.col(distance), horizon).alias(f"{kind}_window"),
        F.col(distance).isNotNull().alias(f"{kind}_found"),
    ]


def shift_seconds(us: Column, horizon: int) -> Column:
    """Whole milliseconds, as seconds; the horizon stands for `not found`."""
    whole = us - F.pmod(us, F.lit(1000))
    return F.coalesce(whole / F.lit(float(MICROS)), F.lit(float(horizon)))


def shift_events(shifts: DataFrame) -> DataFrame:
    """Two rows per tick, `kind` higher or lower: `symbol, timestamp, kind, window_seconds, found`."""
    sides = F.array(*[
        F.struct(
            F.lit(kind).alias("kind"),
            F.col(f"{kind}_window").alias("window_seconds"),
            F.col(f"{kind}_found").alias("found"),
        )
        for kind in (HIGHER, LOWER)
    ])
    return shifts.withColumn("side", F.explode(sides)).select("symbol", "timestamp", "side.*")


def shift_messages(events: DataFrame) -> DataFrame:
    """`kind, value`: the wire form, which has no symbol."""
    require_utc(events.sparkSession)

    def message(kind: str) -> Column:
        return F.to_json(F.struct(
            iso_instant(F.col("timestamp")).alias("timestamp"),
            F.col("window_seconds").alias(f"{kind}_window"),
        ))
    return events.select(
        "kind", F.when(F.col("kind") == HIGHER, message(HIGHER)).otherwise(message(LOWER)).alias("value"))
