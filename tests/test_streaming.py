import os
import random

import pytest
from pyspark.sql import functions as F

from tickflow.operators.ingest import from_wire, parse_ticks, second_price
from tickflow.operators.ladder import unnest_stats, window_stats
from tickflow.operators.shifts import price_shifts, shift_events
from tickflow.operators.zscore import unnest_scores, zscores
from tickflow.schemas import WINDOW_STATS_WIRE, ZSCORES_WIRE, Ladder
from tickflow.session import stream_settings
from tickflow.sinks.write import route_by, route_stream, route_stream_each, run_to_end, to_wire, write_batch, write_stream
from tickflow.sources.ticks import read_records, ticks_as_records
from tickflow.streaming.ladder import (
    SLOTS_SCHEMA, slot_moments_stream, streaming_nested_stats, window_stats_from_slots,
)
from tickflow.streaming.replay import FLUSH_SYMBOL, flush_tick, replay_ticks
from tickflow.streaming.shifts import streaming_price_shifts
from tickflow.streaming.zscore import streaming_nested_scores

S = 1_000_000
LADDER = Ladder.of(a=30, b=60)


def two_per_second(seconds=420, symbols="AB"):
    rng = random.Random(1)
    return [(rng.choice(symbols), round(rng.uniform(1, 9), 2), 1_700_000_010 * S + i * S // 2) for i in range(2 * seconds)]


def rows_of(df, *columns):
    rows = df.filter(F.col("symbol") != FLUSH_SYMBOL).select(*columns).collect()
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


STATS = ("timestamp", "symbol", "window", "avg_price", "std_price")


class Feed:
    """Lands ticks step by step and runs a query on what is new."""

    def __init__(self, spark, ticks_of, tmp_path, build):
        self.spark, self.ticks_of, self.build = spark, ticks_of, build
        self.landing, self.checkpoint, self.out = (str(tmp_path / n) for n in ("in", "checkpoint", "out"))

    def add(self, rows):
        ticks_as_records(self.ticks_of(rows).coalesce(1)).write.mode("append").text(self.landing)
        with stream_settings(self.spark, partitions=2):
            records = read_records(self.spark, "text", self.landing, stream=True)
            run_to_end(write_stream(
                self.build(parse_ticks(records)), self.checkpoint, "parquet", self.out, available_now=True))

    def result(self):
        return self.spark.read.parquet(self.out)


def test_window_stats_equal_batch_and_open_windows_wait(spark, ticks_of, tmp_path):
    rows = two_per_second()
    feed = Feed(spark, ticks_of, tmp_path, lambda t: window_stats(t, LADDER))
    for step in range(3):
        feed.add(rows[step * 280:(step + 1) * 280])
    batch = window_stats(ticks_of(rows), LADDER)
    # The watermark stands ten seconds before the last tick.
    closed = F.unix_micros("timestamp") <= rows[-1][2] - 10 * S
    assert rows_of(feed.result(), *STATS) == rows_of(batch.filter(closed), *STATS)
    assert batch.filter(~closed).count() > 0
    feed.add([(FLUSH_SYMBOL, 0, rows[-1][2] + 10_000 * S)])
    assert rows_of(feed.result(), *STATS) == rows_of(batch, *STATS)


def test_late_tick_is_dropped_from_windows(spark, ticks_of, tmp_path):
    feed = Feed(spark, ticks_of, tmp_path, lambda t: window_stats(t, Ladder.of(a=30)))
    feed.add([("A", 1, 0), ("A", 2, 100 * S)])
    feed.add([("A", 50, S), ("A", 3, 101 * S)])
    feed.add([(FLUSH_SYMBOL, 0, 10_000 * S)])
    got = {r.avg_price for r in feed.result().filter("symbol = 'A'").collect()}
    assert got == {1.0, 2.5}


def test_nested_stats_and_scores_through_the_wire(spark, ticks_of, tmp_path):
    rows = two_per_second()
    ticks = ticks_of(rows)
    stats_out, scores_out = str(tmp_path / "stats"), str(tmp_path / "scores")

    def start_stats(records, checkpoint):
        return write_stream(to_wire(streaming_nested_stats(parse_ticks(records), LADDER)), checkpoint, "text", stats_out, available_now=True)

    replay_ticks(spark, ticks, start_stats, steps=2, flush_twice=True, partitions=2)
    stats = unnest_stats(from_wire(read_records(spark, "text", stats_out), WINDOW_STATS_WIRE))
    assert rows_of(stats, *STATS) == rows_of(window_stats(ticks, LADDER), *STATS)

    def start_scores(records, checkpoint):
        wire = read_records(spark, "text", stats_out, stream=True)
        nested = streaming_nested_scores(
            parse_ticks(records), unnest_stats(from_wire(wire, WINDOW_STATS_WIRE)), LADDER)
        return write_stream(to_wire(nested), checkpoint, "text", scores_out, available_now=True)

    replay_ticks(spark, ticks, start_scores, steps=1, partitions=2)
    got = unnest_scores(from_wire(read_records(spark, "text", scores_out), ZSCORES_WIRE))
    columns = ("timestamp", "symbol", "window", "zscore_price")
    assert rows_of(got, *columns) == rows_of(zscores(ticks, LADDER), *columns)
    assert got.count() > 5


def test_stats_from_slots(spark, ticks_of, tmp_path):
    ticks = ticks_of(two_per_second())
    landed, out = str(tmp_path / "slots"), str(tmp_path / "out")

    def start(records, checkpoint):
        return write_stream(
            slot_moments_stream(parse_ticks(records), LADDER), checkpoint, "parquet", landed, available_now=True)

    replay_ticks(spark, ticks, start, steps=2, flush_twice=True)
    with stream_settings(spark, partitions=2):
        slots = spark.readStream.schema(SLOTS_SCHEMA).parquet(landed)
        run_to_end(write_stream(
            window_stats_from_slots(slots, LADDER), str(tmp_path / "c"), "parquet", out, available_now=True))
    assert rows_of(spark.read.parquet(out), *STATS) == rows_of(window_stats(ticks, LADDER), *STATS)


def test_second_price_on_a_stream(spark, ticks_of, tmp_path):
    rows = two_per_second(60)
    feed = Feed(spark, ticks_of, tmp_path, second_price)
    feed.add(rows)
    feed.add([(FLUSH_SYMBOL, 0, rows[-1][2] + 1000 * S)])
    columns = ("timestamp", "symbol", "price")
    assert rows_of(feed.result(), *columns) == rows_of(second_price(ticks_of(rows)), *columns)


SHIFTS = ("timestamp", "symbol", "kind", "window_seconds", "found")


@pytest.mark.parametrize("emit, slot_seconds", [("final", None), ("final", 60), ("eager", 2)])
def test_shifts_equal_batch(spark, ticks_of, tmp_path, emit, slot_seconds):
    rows = two_per_second(60) + [("A", 3.0, 1_700_000_020 * S)] * 3
    rows.sort(key=lambda r: r[2])
    feed = Feed(
        spark, ticks_of, tmp_path, lambda t: streaming_price_shifts(t, 5, slot_seconds=slot_seconds, emit=emit))
    for step in range(3):
        feed.add(rows[step * 41:(step + 1) * 41])
    if emit == "final":
        # Nothing before the watermark has passed the horizon.
        latest = max(r[0] for r in feed.result().select(F.unix_micros("timestamp")).collect())
        assert latest + 6 * S <= rows[-1][2] - 10 * S
    feed.add([(FLUSH_SYMBOL, 0, rows[-1][2] + 1000 * S)])
    assert rows_of(feed.result(), *SHIFTS) == rows_of(shift_events(price_shifts(ticks_of(rows), 5)), *SHIFTS)


def test_final_shifts_take_ticks_out_of_order(spark, ticks_of, tmp_path):
    feed = Feed(spark, ticks_of, tmp_path, lambda t: streaming_price_shifts(t, 20))
    rows = [("A", 1.0, 100 * S), ("A", 5.0, 108 * S), ("A", 2.0, 102 * S)]
    feed.add(rows[:2])
    feed.add(rows[2:])
    feed.add([("A", 9.0, 50 * S)])  # behind the watermark
    feed.add([(FLUSH_SYMBOL, 0, 1000 * S)])
    assert rows_of(feed.result(), *SHIFTS) == rows_of(shift_events(price_shifts(ticks_of(rows), 20)), *SHIFTS)


def test_batch_operators_refuse_streams(spark, tmp_path):
    records = tmp_path / "records"
    records.mkdir()
    ticks = parse_ticks(read_records(spark, "text", str(records), stream=True))
    for operator in (price_shifts, zscores):
        with pytest.raises(ValueError):
            operator(ticks)
    with pytest.raises(ValueError):
        streaming_price_shifts(ticks, emit="sometimes")


def test_a_replay_leaves_no_scratch_folders(spark, ticks_of, tmp_path, monkeypatch):
    from tickflow.streaming import replay
    made = []
    monkeypatch.setattr(replay, "scratch_dir", lambda _, name: made.append(str(tmp_path / name)) or made[-1])

    def start(records, checkpoint):
        return write_stream(records, checkpoint, "text", str(tmp_path / "out"), available_now=True)
    replay_ticks(spark, ticks_of([("A", 1, 0), ("A", 2, S)]), start, steps=1, partitions=2)
    assert spark.read.text(str(tmp_path / "out")).count() == 3
    assert len(made) == 2 and not any(os.path.exists(path) for path in made)


def test_flush_tick_is_far_ahead(ticks_of):
    ticks = ticks_of([("A", 1, 0)])
    gap = [flush_tick(ticks, n).select(F.unix_micros("timestamp")).first()[0] for n in (1, 2)]
    assert 2 * gap[0] == gap[1] > 10**14


def documents(spark, n=60):
    return spark.range(n).select(
        F.timestamp_seconds("id").alias("timestamp"), F.lit("A").alias("symbol"),
        F.element_at(F.array(F.lit("30s"), F.lit("1m"), F.lit("5m")), (F.col("id") % 3 + 1).cast("int")).alias("window"),
        F.col("id").cast("double").alias("zscore_price"))


def test_route_by_writes_one_folder_per_value(spark, tmp_path):
    path = str(tmp_path / "routes")
    route_by(documents(spark), "window", path)
    back = spark.read.parquet(path)
    assert {r["window"]: r["count"] for r in back.groupBy("window").count().collect()} == {"30s": 20, "1m": 20, "5m": 20}
    assert "PartitionFilters: [isnotnull(window" in back.filter("window = '1m'")._jdf.queryExecution().executedPlan().toString()


def landed_documents(spark, tmp_path):
    path = str(tmp_path / "landed")
    documents(spark).write.parquet(path)
    return spark.readStream.schema(documents(spark).schema).parquet(path)


def test_route_stream_replay_leaves_nothing_twice(spark, tmp_path):
    out = str(tmp_path / "out")
    stream = landed_documents(spark, tmp_path)
    # A lost checkpoint makes the query write its batches again.
    for checkpoint in ("c1", "c2"):
        run_to_end(route_stream(stream, "window", out, str(tmp_path / checkpoint), available_now=True))
    assert spark.read.parquet(out).count() == 60


def test_route_stream_each_hands_every_route_its_rows(spark, tmp_path):
    out = tmp_path / "out"

    def write_route(rows, route, batch_id):
        write_batch(rows, "json", str(out / route / str(batch_id)), mode="overwrite")

    run_to_end(route_stream_each(
        landed_documents(spark, tmp_path), "window", ["30s", "1m", "5m"], write_route, str(tmp_path / "c"),
        available_now=True))
    for route in ("30s", "1m", "5m"):
        rows = spark.read.json(str(out / route / "0"))
        assert rows.count() == 20 and rows.select("window").distinct().first()[0] == route


def test_a_failed_batch_is_written_once_after_restart(spark, tmp_path):
    out, checkpoint, calls = tmp_path / "out", str(tmp_path / "c"), []

    def write_route(rows, route, batch_id):
        calls.append(route)
        if len(calls) == 2:
            raise RuntimeError("lost in the middle of a batch")
        write_batch(rows, "json", str(out / route / str(batch_id)), mode="overwrite")

    def run():
        run_to_end(route_stream_each(
            spark.readStream.schema(documents(spark).schema).parquet(str(tmp_path / "landed")), "window",
            ["30s", "1m", "5m"], write_route, checkpoint, available_now=True))

    landed_documents(spark, tmp_path)
    with pytest.raises(Exception, match="lost in the middle"):
        run()
    run()
    assert calls == ["30s", "1m", "30s", "1m", "5m"]
    assert sum(spark.read.json(str(out / r / "0")).count() for r in ("30s", "1m", "5m")) == 60


def test_scratch_folders_are_new_and_shared(spark):
    from tickflow.session import scratch_dir

    class OnCluster:
        conf = {"spark.checkpoint.dir": "/shared/folder/"}

    assert scratch_dir(OnCluster, "x").startswith("/shared/folder/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_partitioned_stream_sink_and_restart(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    stream = landed_documents(spark, tmp_path)
    for _ in range(2):
        run_to_end(write_stream(stream, checkpoint, "parquet", out, available_now=True, partition_by=["window"]))
    assert spark.read.parquet(out).count() == 60


def test_stream_settings_are_given_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with stream_settings(spark, partitions=2):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_stream_settings_leave_the_number_of_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4000")
    try:
        with stream_settings(spark):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "4000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
