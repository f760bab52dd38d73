"""Price shifts on a stream.

State is kept per (symbol, slot) of event time. A tick asks its question in its
own slot and is shown to the earlier slots that it can be an answer for. Slots
are a fraction of the horizon, so a busy symbol works on several keys at once,
and a key goes away when the watermark has passed everything it waits for.

Of the ticks shown, a slot keeps records: one that an earlier tick after the
slot outdoes both ways answers nothing asked there. Where late ticks count like
others, those are left out before the shuffle; where they are dropped, only the
slot knows which ticks are in time.

`final` only ever appends to a slot: one chunk per micro-batch, read once, when
a timer says that the watermark has passed the slot by the horizon. `eager`
looks at a slot whenever ticks come and writes its state anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickflow.functions.beyond import Scan, nearest_larger
from tickflow.functions.timeline import floor_to, micros
from tickflow.operators.shifts import HIGHER, LOWER, shift_seconds
from tickflow.schemas import LATENESS, MICROS, SHIFT_HORIZON

LATE = "late"
_OUT = "symbol string, us long, price double, kind string, gap long"
_STATE = "us binary, price binary, marks binary"
_ANSWERS = "symbol string, kind string, us array<long>, price array<double>, gap array<long>"
_NO_SLOT = -1  # slots begin at multiples of their width
_SHOWN = "seen timestamp, symbol string, slot long, us binary, price binary, asks binary"

# Marks of a tick in the state of a slot.
_ASKS, _HIGHER_SENT, _LOWER_SENT = 1, 2, 4


def streaming_price_shifts(
    ticks: DataFrame, horizon: int = SHIFT_HORIZON, lateness: int = LATENESS,
    slot_seconds: int | None = None, emit: str = "final", late: str = "drop",
) -> DataFrame:
    """`symbol, timestamp, price, kind, window_seconds, found`: two rows per tick.

    `final` sends both once the watermark has passed the end of a tick's slot by
    the horizon, right also for ticks that came out of order. `eager` sends a
    match as soon as it is seen, which is only right if ticks come in order;
    what was not found follows at the end.

    A tick behind the watermark is dropped, or, with `late="keep"` (`final`
    only), asks and answers as long as its slot waits; one that comes after
    that is sent once, as kind `late` with neither window nor found.
    """
    if emit not in ("final", "eager"):
        raise ValueError(f"unknown emit {emit!r}")
    if late not in ("drop", "keep") or (late == "keep" and emit == "eager"):
        raise ValueError(f"late={late!r} with emit={emit!r}")
    limit = (horizon + 1) * MICROS
    # A slot that is only appended to may be wide; one that is written anew each time should hold less.
    seconds = slot_seconds or -(-(horizon + 1) // (2 if emit == "final" else 4))
    timed = ticks.filter(F.col("price").isNotNull() & F.col("timestamp").isNotNull())
    if emit == "final":
        found = _final(timed, limit, seconds * MICROS, lateness, late == "keep")
    else:
        found = _eager(timed.withWatermark("timestamp", f"{lateness} seconds"), limit, seconds)
    gap = F.when(F.col("gap") >= 0, F.col("gap"))
    shifted = F.col("kind") != LATE
    return found.select(
        "symbol", F.timestamp_micros("us").alias("timestamp"), "price", "kind",
        F.when(shifted, shift_seconds(gap, horizon)).alias("window_seconds"), F.when(shifted, gap.isNotNull()).alias("found"),
    )


def _final(ticks: DataFrame, limit: int, width: int, lateness: int, keep_late: bool) -> DataFrame:
    plain = ticks.select("symbol", F.col("price").cast("double").alias("price"), micros(F.col("timestamp")).alias("us"))
    # Rows carry no event time, so the step itself tells which are late; one row per batch carries the latest.
    shown = plain.mapInArrow(_shown(limit, width, keep_late), _SHOWN).withWatermark("seen", f"{lateness} seconds")
    found = shown.groupBy("symbol", "slot").transformWithState(
        _Slots(limit, width, keep_late), _ANSWERS, "Append", "EventTime")
    return found.select("symbol", "kind", F.explode(F.arrays_zip("us", "price", "gap")).alias("of")).select("symbol", "kind", "of.*")


def _shown(limit: int, width: int, records: bool):
    """Each tick for its own slot, and for the earlier slots that it can have an answer for, if it is a record there.

    What a batch has for a slot is one row, with the ticks as bytes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            symbols = batch.column("symbol").dictionary_encode(null_encoding="encode")
            codes = symbols.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            us, price = batch.column("us").to_numpy(), batch.column("price").to_numpy()
            order = np.lexsort((us, codes))
            codes, us, price = codes[order], us[order], price[order]
            slot = us // width * width
            first = np.searchsorted(codes, codes)
            # The last tick before that is not outdone by this one, either way.
            rivals = [nearest_larger(value, np.nextafter(value, -np.inf), first, np.arange(len(us))) for value in (
                np.where(np.isnan(price), -np.inf, sign * price) for sign in (1, -1))]
            # Symbol and slot in one number, in order.
            low, span = slot.min() - limit - width, slot.max() - slot.min() + 2 * (limit + width)
            place = codes * span + (slot - low)
            rows, slots, asks = [np.arange(len(us))], [slot], [np.ones(len(us), bool)]
            for back in range(width, limit + width, width):
                after = np.searchsorted(place, place - back + width)  # the first tick after that slot
                near = ~np.isnan(price) & (us - (slot - back + width - 1) < limit)
                some = np.flatnonzero(near & ((rivals[0] < after) | (rivals[1] < after)) if records else near)
                rows.append(some)
                slots.append(slot[some] - back)
                asks.append(np.zeros(len(some), bool))
            rows, slots, asks = (np.concatenate(parts) for parts in (rows, slots, asks))
            order = np.lexsort((slots, codes[rows]))
            rows, slots, asks = rows[order], slots[order], asks[order]
            new = np.append(True, (codes[rows][1:] != codes[rows][:-1]) | (slots[1:] != slots[:-1]))
            cuts = np.append(np.flatnonzero(new), len(rows)).tolist()

            def chunks(column: np.ndarray) -> list[bytes]:
                size, data = column.itemsize, column.tobytes()
                return [data[a * size:b * size] for a, b in zip(cuts, cuts[1:])] + [b""]
            # The last row has the time of the batch, on a slot that there is not.
            names = symbols.dictionary.take(pa.array(codes[rows[new]])).cast(pa.string())
            seen = pa.array([None] * len(names) + [int(us.max())], pa.timestamp("us", tz="UTC"))
            yield pa.RecordBatch.from_arrays(
                [seen, pa.concat_arrays([names, pa.nulls(1, pa.string())]), pa.array(np.append(slots[new], _NO_SLOT)),
                 *(pa.array(chunks(column), pa.binary()) for column in (us[rows], price[rows], asks))],
                names=["seen", "symbol", "slot", "us", "price", "asks"])
    return run


class _Slots(StatefulProcessor):
    """Chunks of ticks per slot, and a timer for when nothing in time can come any more."""

    def __init__(self, limit: int, width: int, keep_late: bool):
        self.limit, self.width, self.keep_late = limit, width, keep_late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", "us binary, price binary, asks binary")

    def _end(self, slot: int) -> int:
        return slot + self.width + self.limit

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        symbol, slot = key
        if slot == _NO_SLOT:
            return  # the row that carries the time
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        us, price, asks = _chunks((row.us, row.price, row.asks) for row in rows)
        over = self._end(int(slot)) <= watermark
        if over and self.keep_late and asks.any():
            yield _answers(symbol, LATE, us[asks], price[asks], np.full(asks.sum(), -1))
        in_time = np.full(len(us), not over) if self.keep_late else us > watermark
        if not over and in_time.any():
            kept = np.flatnonzero(in_time)[np.argsort(-us[in_time], kind="stable")]
            kept = kept[_worth_keeping(us[kept], price[kept], int(slot) + self.width)]
            self.chunks.appendList([(us[kept].tobytes(), price[kept].tobytes(), asks[kept].tobytes())])
            self.handle.registerTimer(-(-self._end(int(slot)) // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        symbol, slot = key
        us, price, asks = _chunks(self.chunks.get())
        self.chunks.clear()
        order = np.argsort(-us, kind="stable")
        order = order[_worth_keeping(us[order], price[order], int(slot) + self.width)]
        us, price, asks = us[order], price[order], asks[order]
        if asks.any():
            one_group = np.zeros(len(us), dtype=np.int64)
            for kind, sign in ((HIGHER, 1), (LOWER, -1)):
                gap = Scan(self.limit).answers(one_group, us, sign * price, False)
                yield _answers(symbol, kind, us[asks], price[asks], gap[asks])

    def close(self) -> None:
        pass


def _chunks(rows) -> list[np.ndarray]:
    """Times, prices and whether they ask, from rows of bytes."""
    return [np.frombuffer(b"".join(parts), kind) for parts, kind in zip(zip(*rows), (np.int64, np.float64, bool))]


def _answers(symbol, kind: str, us: np.ndarray, price: np.ndarray, gap: np.ndarray) -> Row:
    return Row(symbol=symbol, kind=kind, us=us.tolist(), price=price.tolist(), gap=gap.tolist())


def _eager(marked: DataFrame, limit: int, seconds: int) -> DataFrame:
    marked = marked.withColumn("us", micros(F.col("timestamp")))
    width = seconds * MICROS
    own = floor_to(F.col("us"), seconds)
    # The earliest slot whose last moment is still within the limit.
    earliest = floor_to(F.col("us") - F.lit(limit - 1), seconds)
    shown = marked.withColumn("slot", F.explode(F.sequence(earliest, own, F.lit(width).cast("long"))))
    keyed = shown.select("timestamp", "symbol", "slot", "us", "price", (F.col("slot") == own).alias("asks"))
    return keyed.groupBy("symbol", "slot").applyInPandasWithState(
        _slot_state(limit, width), _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _slot_state(limit: int, width: int):
    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        symbol, slot = key
        parts = [_load(state)]
        for frame in frames:
            parts.append((frame["us"].to_numpy(dtype=np.int64), frame["price"].to_numpy(dtype=np.float64),
                          np.where(frame["asks"], _ASKS, 0).astype(np.uint8)))
        us, price, marks = (np.concatenate(part) for part in zip(*parts))
        latest_first = np.argsort(-us, kind="stable")
        latest_first = latest_first[_worth_keeping(us[latest_first], price[latest_first], slot + width)]
        us, price, marks = us[latest_first], price[latest_first], marks[latest_first]
        watermark = state.getCurrentWatermarkMs() * 1000

        asks = (marks & _ASKS) > 0
        over = asks & (us + limit <= watermark)
        one_group = np.zeros(len(us), dtype=np.int64)
        for kind, sent, sign in ((HIGHER, _HIGHER_SENT, 1), (LOWER, _LOWER_SENT, -1)):
            if not asks.any():
                break
            gap = Scan(limit).answers(one_group, us, sign * price, False)
            ready = asks & ((marks & sent) == 0) & (over | (gap >= 0))
            marks[ready] |= sent
            if ready.any():
                yield pd.DataFrame({
                    "symbol": symbol, "us": us[ready], "price": price[ready], "kind": kind, "gap": gap[ready]})
        # What the watermark is past by the limit neither asks nor answers any more.
        live = us + limit > watermark
        us, price, marks = us[live], price[live], marks[live]

        open_until = slot + width + limit
        waiting = us[(marks & _ASKS) > 0]
        if watermark >= slot + width and not len(waiting):
            state.remove()
            return
        state.update((us.tobytes(), price.tobytes(), marks.tobytes()))
        wake = waiting.min() + limit if len(waiting) else open_until
        state.setTimeoutTimestamp(max(-(-int(wake) // 1000), watermark // 1000 + 1))
    return step


def _worth_keeping(us: np.ndarray, price: np.ndarray, end: int) -> np.ndarray:
    """All ticks of the slot itself; of those after its end only records.

    A later tick that does not outdo every tick between the end and itself
    answers nothing that is asked before the end, whatever still arrives.
    """
    keep = us < end
    after = price[~keep][::-1]
    if len(after):
        known = ~np.isnan(after)
        records = np.zeros(len(after), dtype=bool)
        for sign in (1, -1):
            value = np.where(known, sign * after, -np.inf)
            top = np.concatenate([[-np.inf], np.maximum.accumulate(value)[:-1]])
            records |= value > top
        keep[~keep] = records[::-1]
    return keep


def _load(state: GroupState):
    us, price, marks = state.get if state.exists else (b"", b"", b"")
    return (
        np.frombuffer(us, dtype=np.int64), np.frombuffer(price, dtype=np.float64),
        np.frombuffer(marks, dtype=np.uint8).copy(),
    )
