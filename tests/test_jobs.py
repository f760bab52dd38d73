import json
import random

import pytest

from pyspark.sql import functions as F

from tickflow.operators.ingest import from_wire
from tickflow.operators.ladder import unnest_stats, window_stats
from tickflow.operators.shifts import price_shifts
from tickflow.operators.zscore import zscores
from tickflow.plans.jobs import (
    End, start_ingest, start_load, start_load_each, start_price_shifts, start_slot_moments, start_window_stats,
    start_window_stats_from_slots, start_zscores,
)
from tickflow.schemas import WINDOW_STATS_WIRE, Ladder
from tickflow.session import stream_settings
from tickflow.sinks.write import read_routes, route_by, route_stream, route_stream_each, run_to_end, write_batch
from tickflow.sources.ticks import ticks_as_records

S = 1_000_000
LADDER = Ladder.of(a=30, b=60)


def test_stages_from_ticks_to_documents(spark, ticks_of, tmp_path):
    rng = random.Random(2)
    rows = [("A", round(rng.uniform(1, 9), 2), 1_700_000_010 * S + i * S // 2) for i in range(400)]
    flush = [("~", 1.0, (1_700_000_010 + 10_000 * n) * S) for n in (1, 2, 3)]
    where = {n: str(tmp_path / n) for n in ("ticks", "stats", "scores", "routes", "a", "b", "higher", "lower")}
    ends = {n: End("text", p) for n, p in where.items()}

    def land(part):
        write_batch(ticks_as_records(ticks_of(part)), "text", where["ticks"])

    land(rows)
    with stream_settings(spark, partitions=2):
        for tick in flush:
            run_to_end(start_window_stats(
                spark, ends["ticks"], ends["stats"], str(tmp_path / "c1"), LADDER, available_now=True))
            land([tick])
        run_to_end(start_window_stats(
            spark, ends["ticks"], ends["stats"], str(tmp_path / "c1"), LADDER, available_now=True))
        run_to_end(start_zscores(
            spark, ends["ticks"], ends["stats"], ends["scores"], str(tmp_path / "c2"), LADDER, available_now=True))
        run_to_end(start_load(spark, ends["scores"], where["routes"], str(tmp_path / "c3"), available_now=True))
        run_to_end(start_load_each(
            spark, ends["scores"], {"a": End("json", where["a"]), "b": End("json", where["b"])},
            str(tmp_path / "c4"), available_now=True))
        run_to_end(start_price_shifts(
            spark, ends["ticks"], ends["higher"], ends["lower"], str(tmp_path / "c5"), available_now=True))

    ticks = ticks_of(rows)
    expected = {(r.timestamp, r.window): round(r.zscore_price, 6) for r in zscores(ticks, LADDER).collect()}
    loaded = spark.read.parquet(where["routes"]).filter("symbol = 'A'").collect()
    assert {(r.timestamp, r.window): round(r.zscore_price, 6) for r in loaded} == expected and len(expected) > 5
    each = {w: spark.read.json(where[w]).filter("symbol = 'A'") for w in ("a", "b")}
    assert sum(df.count() for df in each.values()) == len(expected)
    assert each["a"].select("_id").distinct().count() == each["a"].count()
    assert window_stats(ticks, LADDER).count() > len(expected)

    shifts = price_shifts(ticks).select(F.unix_micros("timestamp").alias("us"), "higher_window", "lower_window").collect()
    for kind in ("higher", "lower"):
        values = [json.loads(r.value) for r in spark.read.text(where[kind]).collect()]
        got = sorted(v[f"{kind}_window"] for v in values if v["timestamp"] < "2023-11-14T23")
        assert got == sorted(r[f"{kind}_window"] for r in shifts)


def test_window_stats_in_two_jobs(spark, ticks_of, tmp_path):
    rows = [("A", float(i % 7), 1_700_000_010 * S + i * S // 2) for i in range(400)]
    ticks, slots, stats = (str(tmp_path / n) for n in ("ticks", "slots", "stats"))
    with stream_settings(spark, partitions=2):
        for part in (rows, [("~", 1.0, 1_700_010_000 * S)], [("~", 1.0, 1_700_020_000 * S)]):
            write_batch(ticks_as_records(ticks_of(part)), "text", ticks)
            run_to_end(start_slot_moments(spark, End("text", ticks), slots, str(tmp_path / "c1"), LADDER, available_now=True))
        run_to_end(start_window_stats_from_slots(
            spark, slots, End("text", stats), str(tmp_path / "c2"), LADDER, available_now=True))
    nested = from_wire(spark.read.text(stats), WINDOW_STATS_WIRE).filter("symbol = 'A'")

    def flat(df):
        return sorted((r.timestamp, r.window, round(r.avg_price, 6), r.std_price and round(r.std_price, 6)) for r in df.collect())
    assert flat(unnest_stats(nested)) == flat(window_stats(ticks_of(rows), LADDER))


def test_ingest_publishes_good_and_keeps_rejected(spark, tmp_path):
    raw = ['{"symbol":"A","price":"1.50"}', '{"symbol":"B","price":2,"timestamp":"1999-01-01T00:00:00Z"}',
           "", "junk", '{"symbol":"A"}', '{"symbol":"A","price":"x"}']
    where = {n: str(tmp_path / n) for n in ("raw", "ticks", "rejected")}
    spark.createDataFrame([(v,) for v in raw], "value string").write.text(where["raw"])
    for _ in range(2):
        run_to_end(start_ingest(
            spark, *(End("text", where[n]) for n in ("raw", "ticks", "rejected")), str(tmp_path / "c"),
            available_now=True))
    ticks = [json.loads(r.value) for r in spark.read.text(where["ticks"]).collect()]
    assert sorted((t["symbol"], t["price"]) for t in ticks) == [("A", "1.50"), ("B", "2")]
    assert all(t["timestamp"] > "2024" and t["timestamp"].endswith("+00:00") for t in ticks)
    rejected = [json.loads(r.value) for r in spark.read.text(where["rejected"]).collect()]
    assert sorted(r["reject_reason"] for r in rejected) == ["bad_price", "missing_field", "not_json"]


class _FailsOnce(End):
    failed = False

    def write(self, df, part=None):
        if not _FailsOnce.failed:
            _FailsOnce.failed = True
            raise OSError("lost")
        super().write(df, part)


def test_a_replay_between_two_outputs_adds_nothing_downstream(spark, ticks_of, tmp_path):
    where = {n: str(tmp_path / n) for n in ("raw", "ticks", "rejected", "copy")}
    rows = [("A", float(i), 1_700_000_000 * S + i * S) for i in range(10)]
    write_batch(ticks_as_records(ticks_of(rows)).unionByName(spark.createDataFrame([("junk",)], "value string")), "text", where["raw"])
    ends = End("text", where["raw"]), End("text", where["ticks"]), _FailsOnce("text", where["rejected"])

    def downstream():
        stream = End("text", where["ticks"]).stream(spark).select("value")
        run_to_end(End("text", where["copy"]).start(stream, str(tmp_path / "c2"), True))
    with pytest.raises(Exception, match="lost"):
        run_to_end(start_ingest(spark, *ends, str(tmp_path / "c1"), available_now=True))
    downstream()
    run_to_end(start_ingest(spark, *ends, str(tmp_path / "c1"), available_now=True))
    downstream()
    assert spark.read.text(where["copy"]).count() == 10
    assert spark.read.text(where["rejected"]).count() == 1


def test_routes_keep_labels_that_look_like_numbers(spark, tmp_path):
    rows = spark.createDataFrame([("1d", 1), ("2d", 2), ("1", 3)], "window string, n long")
    path, stream_in, stream_out = (str(tmp_path / n) for n in "abc")
    route_by(rows, "window", path)
    assert sorted(map(tuple, read_routes(spark, "window", path, rows.schema).collect())) == [("1", 3), ("1d", 1), ("2d", 2)]
    rows.write.parquet(stream_in)
    for _ in range(2):
        run_to_end(route_stream(spark.readStream.schema(rows.schema).parquet(stream_in), "window", stream_out, str(tmp_path / "d"), available_now=True))
    assert sorted(map(tuple, read_routes(spark, "window", stream_out, rows.schema).collect())) == [("1", 3), ("1d", 1), ("2d", 2)]


def test_a_window_without_destination_is_an_error(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("z", 2)], "window string, n long")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="no destination for window = 'z'"):
        run_to_end(route_stream_each(stream, "window", ["a"], lambda *_: None, str(tmp_path / "c"), available_now=True))
