"""The window ladder on a stream, in one read and one stateful step.

Ticks are summed up per symbol and slot where they are read, so a hot symbol
sends a row per slot and task of a micro-batch. The step is keyed by symbol and
block (the interval into which all windows nest) and keeps the moments of each
open window: count, mean, squared distances from it, least and largest price,
which merge pairwise. State is a few numbers per open window, whatever the
ticks, slots or widths. When the watermark reaches the end of a window, all
windows that end there leave as one row, in ladder order.

Rows of moments carry no event time, so none is dropped on its way; one row per
batch carries the latest, which moves the watermark. A moment is late for a
window that has ended by the watermark, and still counts in wider ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickflow.functions.moments import FIELDS, slot_moments
from tickflow.functions.timeline import floor_to, micros
from tickflow.operators.ladder import unnest_stats
from tickflow.schemas import LADDER, LATENESS, MICROS, Ladder

SLOTS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("m2", T.DoubleType()),
    T.StructField("lo", T.DoubleType()),
    T.StructField("hi", T.DoubleType()),
])

_NO_COUNT = -1
_PARTS = "seen timestamp, symbol string, slot long, n long, mean double, m2 double, lo double, hi double"
_CLOSED = "at long, symbol string, labels array<string>, counts array<long>, means array<double>, deviations array<double>"
# A window in the state of a block. An empty one (no price, but a tick) has mean 0 and no extremes.
_WINDOW = np.dtype([("rung", "i4"), ("at", "i8"), ("n", "i8"), ("mean", "f8"), ("m2", "f8"), ("lo", "f8"), ("hi", "f8")])


def streaming_window_stats(ticks: DataFrame, ladder: Ladder = LADDER, lateness: int = LATENESS) -> DataFrame:
    """`window_stats` rows."""
    return unnest_stats(streaming_nested_stats(ticks, ladder, lateness))


def streaming_nested_stats(ticks: DataFrame, ladder: Ladder = LADDER, lateness: int = LATENESS) -> DataFrame:
    """`nested_window_stats` rows."""
    timed = ticks.filter(F.col("timestamp").isNotNull()).select("symbol", F.col("price").cast("double").alias("price"), micros(F.col("timestamp")).alias("us"))
    return _closed_windows(timed.mapInArrow(_tick_parts(ladder.slot * MICROS), _PARTS), ladder, lateness)


def slot_moments_stream(ticks: DataFrame, ladder: Ladder = LADDER, lateness: int = LATENESS) -> DataFrame:
    """Moments per slot to be stored: `SLOTS_SCHEMA` rows, `timestamp` = slot start."""
    marked = ticks.withWatermark("timestamp", f"{lateness} seconds")
    per_slot = marked.groupBy(F.window("timestamp", f"{ladder.slot} seconds").alias("span"), "symbol").agg(
        *slot_moments(F.col("price")))
    return per_slot.select(F.col("span.start").alias("timestamp"), "symbol", *FIELDS)


def window_stats_from_slots(slot_rows: DataFrame, ladder: Ladder = LADDER, lateness: int = 0) -> DataFrame:
    """`window_stats` rows from the stream of stored slots."""
    return unnest_stats(nested_stats_from_slots(slot_rows, ladder, lateness))


def nested_stats_from_slots(slot_rows: DataFrame, ladder: Ladder = LADDER, lateness: int = 0) -> DataFrame:
    """`nested_window_stats` rows from the stream of stored slots.

    A slot is stored once the first query's watermark has passed it, so commit
    after commit they come in order and none is late. Only where a trigger
    takes part of a commit, `lateness` has to cover a commit's span.
    """
    timed = slot_rows.select("symbol", micros(F.col("timestamp")).alias("us"), *FIELDS)
    return _closed_windows(timed.mapInArrow(_slot_parts, _PARTS), ladder, lateness)


def _part_rows(symbol: pa.Array, slot, n, mean, m2, lo, hi, latest: int) -> pa.RecordBatch:
    """Moments, and a row that carries the time of the batch, with a count that there is not."""
    some = n > 0
    columns = [(slot, 0), (n, _NO_COUNT)] + [
        (np.where(some, value, instead), 0.0) for value, instead in ((mean, 0.0), (m2, 0.0), (lo, np.inf), (hi, -np.inf))]
    seen = pa.array([None] * len(n) + [latest], pa.timestamp("us", tz="UTC"))
    return pa.RecordBatch.from_arrays(
        [seen, pa.concat_arrays([symbol.cast(pa.string()), pa.nulls(1, pa.string())]),
         *(pa.array(np.append(column, last)) for column, last in columns)],
        names=["seen", "symbol", "slot", "n", "mean", "m2", "lo", "hi"])


def _tick_parts(slot: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            us, price = batch.column("us").to_numpy(), batch.column("price")
            known = price.is_valid().to_numpy(zero_copy_only=False)
            value = price.fill_null(0.0).to_numpy()
            symbols = batch.column("symbol").dictionary_encode(null_encoding="encode")
            codes, slots = symbols.indices.to_numpy(zero_copy_only=False), us // slot * slot
            order = np.lexsort((slots, codes))
            codes, slots, value, known = codes[order], slots[order], value[order], known[order]
            first = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (slots[1:] != slots[:-1])))
            n, mean, m2, lo, hi = _merged(
                first, known.astype(np.int64), value, np.zeros(len(value)), np.where(known, value, np.inf), np.where(known, value, -np.inf))
            yield _part_rows(symbols.dictionary.take(pa.array(codes[first])), slots[first], n, mean, m2, lo, hi, int(us.max()))
    return run


def _slot_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            us, n = batch.column("us").to_numpy(), batch.column("n").to_numpy()
            total, m2, lo, hi = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("total", "m2", "lo", "hi"))
            yield _part_rows(batch.column("symbol"), us, n, total / np.maximum(n, 1), m2, lo, hi, int(us.max()))


def _merged(first: np.ndarray, n, mean, m2, lo, hi):
    """Moments of runs of moments; a run begins at each of `first`.

    NaN prices are larger than all others, as they are for Spark.
    """
    with np.errstate(invalid="ignore", over="ignore"):
        count = np.add.reduceat(n, first)
        middle = np.add.reduceat(n * mean, first) / np.maximum(count, 1)
        distance = mean - np.repeat(middle, np.diff(np.append(first, len(n))))
        spread = np.add.reduceat(np.where(n > 0, m2 + n * distance * distance, 0.0), first)
        return count, middle, spread, np.fmin.reduceat(lo, first), np.maximum.reduceat(hi, first)


def _closed_windows(parts: DataFrame, ladder: Ladder, lateness: int) -> DataFrame:
    timed = parts.withWatermark("seen", f"{lateness} seconds").withColumn("block", floor_to(F.col("slot"), ladder.block))
    closed = timed.groupBy("symbol", "block").applyInPandasWithState(
        _block_step(ladder), _CLOSED, "windows binary", "append", GroupStateTimeout.EventTimeTimeout)

    def value(name: str, least: int):
        return lambda w: F.when(w["counts"] >= least, F.coalesce(w[name], F.lit(float("nan"))))
    mean, spread = value("means", 1), value("deviations", 2)
    return closed.select(
        F.timestamp_micros("at").alias("timestamp"), "symbol",
        F.transform(F.arrays_zip("labels", "counts", "means", "deviations"), lambda w: F.struct(
            w["labels"].alias("window"), mean(w).alias("avg_price"), spread(w).alias("std_price"))).alias("stats"))


def _block_step(ladder: Ladder) -> Callable:
    labels = ladder.labels
    widths = np.array([width * MICROS for _, width in ladder.rungs])

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        symbol, _ = key
        watermark = state.getCurrentWatermarkMs() * 1000
        windows = [np.frombuffer(state.get[0], _WINDOW)] if state.exists else []
        for frame in frames:
            frame = frame[frame["n"] != _NO_COUNT]
            for rung, width in enumerate(widths):
                part = np.zeros(len(frame), _WINDOW)
                for name in ("n", "mean", "m2", "lo", "hi"):
                    part[name] = frame[name].to_numpy(_WINDOW[name])
                part["rung"], part["at"] = rung, frame["slot"].to_numpy(np.int64) // width * width + width
                windows.append(part[part["at"] > watermark])
        held = np.concatenate(windows) if windows else np.zeros(0, _WINDOW)
        if len(held):
            held = held[np.lexsort((held["rung"], held["at"]))]
            new = np.append(True, (held["rung"][1:] != held["rung"][:-1]) | (held["at"][1:] != held["at"][:-1]))
            first = np.flatnonzero(new)
            whole = held[first].copy()
            whole["n"], whole["mean"], whole["m2"], whole["lo"], whole["hi"] = _merged(
                first, *(held[name] for name in ("n", "mean", "m2", "lo", "hi")))
            held = whole
        closed, held = held[held["at"] <= watermark], held[held["at"] > watermark]
        if len(closed):
            yield _rows(symbol, closed, labels)
        if not len(held):
            if state.exists:
                state.remove()
            return
        state.update((held.tobytes(),))
        # A timeout is due once the watermark is beyond it.
        state.setTimeoutTimestamp(max(int(held["at"].min()) // 1000 - 1, watermark // 1000 + 1))
    return step


def _rows(symbol, closed: np.ndarray, labels: list[str]) -> pd.DataFrame:
    flat = (closed["lo"] == closed["hi"]) & np.isfinite(closed["lo"])
    with np.errstate(invalid="ignore"):
        deviation = np.where(flat, 0.0, np.sqrt(closed["m2"] / np.maximum(closed["n"] - 1, 1)))
    ends, first = np.unique(closed["at"], return_index=True)
    runs = [slice(a, b) for a, b in zip(first, [*first[1:], len(closed)])]
    return pd.DataFrame({
        "at": ends, "symbol": symbol, "labels": [[labels[i] for i in closed["rung"][r]] for r in runs],
        **{name: [values[r].tolist() for r in runs] for name, values in (
            ("counts", closed["n"]), ("means", closed["mean"]), ("deviations", deviation))}})
