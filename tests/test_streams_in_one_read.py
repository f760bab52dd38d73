"""Streams: one read, state that follows what is new, late ticks, start positions, hand-over, which query ended."""

import datetime as dt
import json
import os
import random
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tickflow.operators.ingest import parse_ticks
from tickflow.operators.ladder import unnest_stats, window_stats
from tickflow.operators.shifts import price_shifts, shift_events
from tickflow.plans.jobs import End, start_ingest, start_load_each, start_window_stats
from tickflow.schemas import Ladder
from tickflow.session import stream_settings
from tickflow.sinks.handover import handed_over, ledger_of
from tickflow.sinks.write import await_any, run_to_end, write_batch, write_stream
from tickflow.sources.ticks import read_records, ticks_as_records
from tickflow.streaming.ladder import _WINDOW, _block_step, _tick_parts, streaming_nested_stats, streaming_window_stats
from tickflow.streaming.shifts import _shown, _Slots, streaming_price_shifts

S = 1_000_000
LADDER = Ladder.of(a=30, b=60, c=300)


def some_ticks(n=600, symbols="AAAB"):
    rng = random.Random(3)
    return [(rng.choice(symbols), round(rng.uniform(1, 9), 2), 1_700_000_010 * S + i * S // 2) for i in range(n)]


def rounded_rows(df, *columns):
    return sorted(repr(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.select(*columns).collect())


# The ladder


def test_a_ladder_reads_each_tick_once(spark, ticks_of, tmp_path):
    rows = some_ticks()
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    ticks_as_records(ticks_of(rows + [("~", 0.0, (1_700_000_010 + 10**6) * S)], 5)).write.text(landing)
    with stream_settings(spark, partitions=2):
        query = start_window_stats(spark, End("text", landing), End("text", out), str(tmp_path / "c"), LADDER, available_now=True)
        run_to_end(query)
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(rows) + 1
    assert all(len(p["stateOperators"]) == 1 for p in query.recentProgress)


class FakeState:
    def __init__(self, watermark=0):
        self.value, self.watermark, self.timeout = None, watermark, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, ms):
        assert ms > self.watermark
        self.timeout = ms


def parts_of(prices, us, slot):
    batch = pa.RecordBatch.from_pydict({"symbol": ["A"] * len(us), "price": prices, "us": us})
    return pa.Table.from_batches(list(_tick_parts(slot)(iter([batch])))).to_pandas().iloc[:-1]


def test_state_of_a_window_does_not_grow_with_its_slots():
    day, sizes = 86_400, {}
    for fine in (1, 60, 3600):
        ladder, state = Ladder.of(fine=fine, day=day), FakeState()
        step = _block_step(ladder)
        us = (np.arange(5000) * day * S // 5001).astype(np.int64)
        for part in np.array_split(us, 4):
            # All windows but the last fine one and the day have closed when the next part comes.
            state.watermark = int(part[0]) // 1000
            list(step(("A", 0), iter([parts_of([1.5] * len(part), part, ladder.slot * S)]), state))
        state.watermark = int(us[-1]) // 1000
        list(step(("A", 0), iter([]), state))
        sizes[fine] = len(state.value[0])
    assert sizes == dict.fromkeys(sizes, 2 * _WINDOW.itemsize)


def test_merged_moments_equal_plain_ones():
    rng = np.random.default_rng(1)
    price, us = (rng.normal(size=400) + 1e9), np.sort(rng.integers(0, 60 * S, 400))
    state, out = FakeState(), []
    step = _block_step(Ladder.of(a=20, b=60))
    for part in np.array_split(np.arange(400), 7):
        out += list(step(("A", 0), iter([parts_of(price[part], us[part], 20 * S)]), state))
    state.watermark = 60_000
    out = pd.concat(out + list(step(("A", 0), iter([]), state)))
    assert not state.exists
    for at, labels, counts, means, deviations in out[["at", "labels", "counts", "means", "deviations"]].itertuples(index=False):
        for label, n, mean, deviation in zip(labels, counts, means, deviations):
            inside = price[(us < at) & (us >= at - {"a": 20, "b": 60}[label] * S)]
            assert (n, round(mean, 4), round(deviation, 5)) == (len(inside), round(inside.mean(), 4), round(inside.std(ddof=1), 5))
    assert [list(r) for r in out["labels"]] == [["a"], ["a"], ["a", "b"]]


def test_odd_prices_and_symbols_on_a_ladder(spark, ticks_of, tmp_path):
    rows = [("A", None, 0), ("A", None, 31 * S), ("A", 2.0, 32 * S), (None, 5.0, S), (None, 5.0, 2 * S), ("N", float("nan"), S),
            ("N", 1.0, 2 * S), ("I", float("inf"), S), ("I", 1.0, 2 * S), ("F", 0.1, S), ("F", 0.1, 2 * S), ("F", 0.1, 40 * S)]
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    ticks = ticks_of(rows)
    ticks.unionByName(ticks_of([("~", 0.0, 10**6 * S)])).write.parquet(landing)
    with stream_settings(spark, partitions=2):
        stats = streaming_window_stats(spark.readStream.schema(ticks.schema).parquet(landing), LADDER)
        run_to_end(write_stream(stats, str(tmp_path / "c"), "parquet", out, available_now=True))
    columns = ("timestamp", "symbol", "window", "avg_price", "std_price")
    got = rounded_rows(spark.read.parquet(out).filter("symbol is distinct from '~'"), *columns)
    assert got == rounded_rows(window_stats(ticks, LADDER), *columns)


def test_a_late_tick_counts_where_its_window_is_open(spark, ticks_of, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    for rows in ([("A", 1.0, 0), ("A", 3.0, 100 * S)], [("A", 7.0, 5 * S)], [("~", 0.0, 10**6 * S)]):
        ticks_as_records(ticks_of(rows)).write.mode("append").text(landing)
        with stream_settings(spark, partitions=2):
            stats = streaming_nested_stats(parse_ticks(read_records(spark, "text", landing, stream=True)), LADDER)
            run_to_end(write_stream(stats, checkpoint, "parquet", out, available_now=True))
    got = {(r.window, r.avg_price) for r in unnest_stats(spark.read.parquet(out)).filter("symbol = 'A'").collect()}
    assert got == {("a", 1.0), ("b", 1.0), ("a", 3.0), ("b", 3.0), ("c", 11 / 3)}


# Price shifts


class FakeHandle:
    def __init__(self):
        self.lists, self.timers, self.written = {}, [], []

    def getListState(self, name, schema):
        handle, chunks = self, []

        class State:
            def appendList(self, rows):
                chunks.extend(rows)
                handle.written.append(sum(len(field) for row in rows for field in row))

            def get(self):
                return iter(chunks)

            def clear(self):
                chunks.clear()
        return State()

    def registerTimer(self, ms):
        self.timers.append(ms)


class Clock:
    def __init__(self, ms=0):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_state_written_follows_the_new_ticks():
    slots, handle = _Slots(limit=21 * S, width=6 * S, keep_late=True), FakeHandle()
    slots.init(handle)
    rng = np.random.default_rng(1)
    for n in (4000, 50, 50, 7):
        chunk = Row(us=rng.integers(0, 6 * S, n).tobytes(), price=rng.random(n).tobytes(), asks=np.ones(n, bool).tobytes())
        list(slots.handleInputRows(("A", 0), iter([chunk]), Clock()))
    assert handle.written == [17 * n for n in (4000, 50, 50, 7)]
    assert set(handle.timers) == {27_000}
    out = list(slots.handleExpiredTimer(("A", 0), Clock(27_000), None))
    assert [(r.kind, len(r.us), len(r.gap)) for r in out] == [("higher", 4107, 4107), ("lower", 4107, 4107)]
    assert not list(slots.chunks.get())


def test_a_hot_symbol_works_on_several_keys_and_shows_few_ticks():
    us = np.arange(5000) * 40 * S // 5000
    price = np.random.default_rng(2).random(5000)
    batch = pa.RecordBatch.from_pydict({"symbol": ["A"] * 5000, "price": price, "us": us})
    rows = {records: pa.Table.from_batches(list(_shown(21 * S, 6 * S, records)(iter([batch])))).to_pylist()[:-1] for records in (False, True)}
    ticks = {records: sum(len(r["asks"]) for r in some) for records, some in rows.items()}
    assert all(len({r["slot"] for r in some}) == len(some) >= 7 for some in rows.values())
    assert all(sum(map(sum, (r["asks"] for r in some))) == 5000 for some in rows.values())
    assert ticks[True] < 5000 * 1.05 < 3 * 5000 < ticks[False]


def test_late_ticks_are_kept_while_their_slot_waits(spark, ticks_of, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    in_time = [("A", 1.0, 100 * S), ("A", 5.0, 130 * S), ("A", 4.0, 131 * S)]
    kept, too_late = [("A", 9.0, 110 * S), ("A", 2.0, 112 * S)], [("A", 9.0, 50 * S), ("B", 1.0, 51 * S)]
    for rows in (in_time, kept + too_late, [("~", 0.0, 10**4 * S)]):
        ticks_as_records(ticks_of(rows)).write.mode("append").text(landing)
        with stream_settings(spark, partitions=2):
            shifts = streaming_price_shifts(parse_ticks(read_records(spark, "text", landing, stream=True)), 20, late="keep")
            run_to_end(write_stream(shifts, checkpoint, "parquet", out, available_now=True))
    got = spark.read.parquet(out).filter("symbol != '~'")
    columns = ("timestamp", "symbol", "kind", "window_seconds", "found")
    expected = shift_events(price_shifts(ticks_of(in_time + kept)))
    assert rounded_rows(got.filter("kind != 'late'"), *columns) == rounded_rows(expected, *columns)
    late = got.filter("kind = 'late'").select("symbol", F.unix_micros("timestamp"), "price", "window_seconds", "found").collect()
    assert sorted(map(tuple, late)) == [("A", 50 * S, 9.0, None, None), ("B", 51 * S, 1.0, None, None)]


def test_late_ticks_cannot_be_kept_by_eager_shifts(ticks_of):
    for options in ({"late": "maybe"}, {"late": "keep", "emit": "eager"}):
        with pytest.raises(ValueError, match="late"):
            streaming_price_shifts(ticks_of([]), **options)


# Start position


def land(folder, name, values, modified=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as file:
        file.write("".join(f"{v}\n" for v in values))
    if modified:
        os.utime(path, (modified, modified))


def copied(spark, folder, out, checkpoint, start):
    records = read_records(spark, "text", folder, stream=True, start=start, checkpoint=checkpoint)
    run_to_end(write_stream(records, checkpoint, "text", out, available_now=True))
    return sorted(r.value for r in spark.read.text(out).collect())


def test_a_folder_from_its_latest_file_on_skips_history_once(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    now = int(time.time())
    land(folder, "a", ["1", "2"], now - 1000)
    land(folder, "b", ["3"], now - 100)
    assert copied(spark, folder, out, checkpoint, "latest") == []
    land(folder, "c", ["4"], now - 50)
    assert copied(spark, folder, out, checkpoint, "latest") == ["4"]
    land(folder, "d", ["5"], now - 10)  # lands while the query is down
    assert copied(spark, folder, out, checkpoint, "latest") == ["4", "5"]


@pytest.mark.parametrize("start, expected", [("earliest", ["1", "2", "3"]), (None, ["1", "2", "3"]), (-500, ["2", "3"]), (-100, ["2", "3"])])
def test_a_folder_from_an_instant_on(spark, tmp_path, start, expected):
    folder = str(tmp_path / "in")
    now = int(time.time())
    for name, value, ago in (("a", "1", 1000), ("b", "2", 100), ("c", "3", 50)):
        land(folder, name, [value], now - ago)
    if isinstance(start, int):
        start = dt.datetime.fromtimestamp(now + start, dt.timezone.utc)
    assert copied(spark, folder, str(tmp_path / "out"), str(tmp_path / "c"), start) == expected


def test_a_start_position_needs_a_checkpoint_and_a_known_name(spark, tmp_path):
    land(str(tmp_path / "in"), "a", ["1"])
    with pytest.raises(ValueError, match="checkpoint"):
        read_records(spark, "text", str(tmp_path / "in"), stream=True, start="latest")
    with pytest.raises(ValueError, match="unknown start"):
        read_records(spark, "text", str(tmp_path / "in"), stream=True, start="noon", checkpoint=str(tmp_path / "c"))


class Reader:
    """Stands for a session, to see what a source is asked for."""

    def __init__(self):
        self.asked = {}
        self.readStream = self.read = self

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def load(self):
        return self

    def select(self, *columns):
        return self.asked


@pytest.mark.parametrize("start, options, expected", [
    (None, {}, {"startingOffsets": "latest"}),
    ("earliest", {}, {"startingOffsets": "earliest"}),
    (None, {"startingOffsets": "earliest", "subscribe": "t"}, {"startingOffsets": "earliest", "subscribe": "t"}),
    (dt.datetime(1970, 1, 1, 0, 0, 5, tzinfo=dt.timezone.utc), {}, {"startingTimestamp": "5000"}),
])
def test_log_sources_are_told_where_to_start(spark, start, options, expected):
    assert read_records(Reader(), "kafka", stream=True, options=options, start=start) == {"format": "kafka", **expected}
    assert read_records(Reader(), "kafka", options=options) == {"format": "kafka", **options}


# Hand-over


STEPS = ["good aside", "rejected aside", "committed", "good seen", "rejected seen"]


@pytest.mark.parametrize("step", STEPS)
def test_a_batch_stopped_at_any_step_is_seen_once(spark, ticks_of, tmp_path, step):
    where = {n: str(tmp_path / n) for n in ("raw", "good", "rejected", "copy")}
    checkpoint, reader = str(tmp_path / "c1"), str(tmp_path / "c2")
    rows = [("A", float(i), 1_700_000_000 * S + i * S) for i in range(10)]
    write_batch(ticks_as_records(ticks_of(rows)).unionByName(spark.createDataFrame([("junk",)], "value string")), "text", where["raw"])

    def ingest(stop=None):
        def at_step(done):
            if done == stop:
                raise OSError(f"stopped after {done}")
        run_to_end(start_ingest(
            spark, *(End("text", where[n]) for n in ("raw", "good", "rejected")), checkpoint, available_now=True, at_step=at_step))

    def downstream():
        run_to_end(End("text", where["copy"]).start(End("text", where["good"]).stream(spark), reader, True))
        return spark.read.text(where["copy"]).count()

    with pytest.raises(Exception, match="stopped after"):
        ingest(step)
    assert downstream() == (10 if step in ("good seen", "rejected seen") else 0)
    seen = sorted(f for _, _, files in os.walk(where["good"]) for f in files if f.startswith("part") and "_aside" not in _)
    ingest()
    ingest()
    if seen and step in ("good seen", "rejected seen"):
        assert set(seen) <= {f for _, _, files in os.walk(where["good"]) for f in files}
    assert downstream() == 10
    assert spark.read.text(where["rejected"]).count() == 1
    committed = {(r.output, r.rows) for r in handed_over(spark, ledger_of(checkpoint)).collect()}
    assert committed == {("good", 10), ("rejected", 1)}


def test_an_output_that_is_no_folder_is_written_after_the_commit(spark, tmp_path):
    class Topic(End):
        calls = []

        def write(self, df, part=None):
            Topic.calls.append((part, df.count()))

    values = [json.dumps({"timestamp": "2024-01-01T00:00:00Z", "symbol": "A", "zscores": [{"window": "a", "zscore_price": 1.0}]})]
    land(str(tmp_path / "in"), "x", values)
    run_to_end(start_load_each(
        spark, End("text", str(tmp_path / "in")), {"a": Topic("memory")}, str(tmp_path / "c"), available_now=True))
    assert Topic.calls == [(None, 1)]
    assert [r.rows for r in handed_over(spark, ledger_of(str(tmp_path / "c"))).collect()] == [1]


# Which query ended


def rate(spark, body=None):
    stream = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    return stream.withColumn("value", body) if body is not None else stream


def started(df, name, **trigger):
    return df.writeStream.format("noop").queryName(name).trigger(**trigger).start()


def test_the_query_that_failed_is_named_and_the_others_stop(spark):
    steady = started(rate(spark), "steady", processingTime="1 second")
    broken = started(rate(spark, F.assert_true(F.col("value") < 0)), "broken", processingTime="1 second")
    [ended] = await_any(spark, [steady, broken])
    assert (ended.name, ended.id) == ("broken", broken.id) and "ASSERT_TRUE" in ended.error.upper().replace("'", "") or "is not true" in ended.error
    assert not steady.isActive


def test_the_query_that_ended_is_named_and_others_may_go_on(spark, tmp_path):
    land(str(tmp_path / "in"), "a", ["1"])
    steady = started(rate(spark), "goes on", processingTime="1 second")
    try:
        short = started(read_records(spark, "text", str(tmp_path / "in"), stream=True), "short", availableNow=True)
        [ended] = await_any(spark, [steady, short], stop_others=False)
        assert (ended.name, ended.error) == ("short", None) and steady.isActive
    finally:
        steady.stop()


def test_waiting_for_no_query_is_an_error(spark):
    with pytest.raises(ValueError, match="no query"):
        await_any(spark, [])
