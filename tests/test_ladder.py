import json
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tickflow.operators.ingest import from_wire, second_price
from tickflow.operators.ladder import nest_stats, nested_window_stats, unnest_stats, window_stats
from tickflow.operators.zscore import nest_scores, nested_zscores, score, unnest_scores, zscores
from tickflow.schemas import LADDER, WINDOW_STATS_WIRE, Ladder
from tickflow.sinks.write import to_wire

S = 1_000_000
SMALL = Ladder.of(a=3, b=6, c=12)
UNEVEN = Ladder.of(a=2, b=3, c=5)


def random_ticks(seed, n=400, span=60, symbols="AAAB"):
    rng = random.Random(seed)
    return [(rng.choice(symbols), round(rng.uniform(1, 9), 2), rng.randrange(-5 * S, span * S)) for _ in range(n)]


def expected_stats(rows, ladder):
    groups = {}
    for symbol, price, us in rows:
        for label, width in ladder.rungs:
            end = (us // (width * S) + 1) * width * S
            groups.setdefault((symbol, label, end), []).append(price)
    return {
        key: (statistics.fmean(v), statistics.stdev(v) if len(v) > 1 else None) for key, v in groups.items()}


def got_stats(df):
    rows = df.select("symbol", "window", F.unix_micros("timestamp").alias("us"), "avg_price", "std_price").collect()
    return {(r.symbol, r.window, r.us): (r.avg_price, r.std_price) for r in rows}


def assert_close(got, expected):
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        for g, e in zip(got[key], values):
            assert (g is None) == (e is None) and (e is None or math.isclose(g, e, rel_tol=1e-9, abs_tol=1e-9)), key


@pytest.mark.parametrize("ladder", [SMALL, UNEVEN])
@pytest.mark.parametrize("seed", [0, 1])
def test_stats_equal_brute_force(ticks_of, seed, ladder):
    rows = random_ticks(seed)
    assert_close(got_stats(window_stats(ticks_of(rows, 5), ladder)), expected_stats(rows, ladder))


def test_long_blocks_take_the_other_way(ticks_of):
    rows, ladder = random_ticks(3), Ladder(SMALL.rungs, slots_per_task=1)
    assert SMALL.blocks_are_small and not ladder.blocks_are_small
    assert_close(got_stats(window_stats(ticks_of(rows), ladder)), expected_stats(rows, ladder))


def test_stats_equal_plain_aggregates(ticks_of):
    ticks = ticks_of(random_ticks(4, n=3000, span=4000))
    for label, width in LADDER.rungs:
        plain = ticks.groupBy(F.window("timestamp", f"{width} seconds"), "symbol").agg(
            F.avg("price").alias("avg_price"), F.stddev("price").alias("std_price"),
        ).select("symbol", F.lit(label).alias("window"), F.col("window.end").alias("timestamp"), "avg_price", "std_price")
        ours = window_stats(ticks, LADDER).filter(F.col("window") == label)
        assert_close(got_stats(ours), got_stats(plain))


def test_edges_of_a_window(ticks_of):
    ladder = Ladder.of(a=10)
    rows = [
        ("lone", 5, 1), ("flat", 0.1, 1), ("flat", 0.1, 2), ("flat", 0.1, 3),
        ("edge", 1, 10 * S - 1), ("edge", 2, 10 * S), (None, 3, 1), (None, 5, 2), ("void", None, 1), ("half", None, 1),
        ("half", 4, 2), ("nan", "nan", 1), ("nan", 1, 2), ("notime", 1, None),
    ]
    got = got_stats(window_stats(ticks_of(rows), ladder))
    ten, twenty = 10 * S, 20 * S
    assert got[("lone", "a", ten)] == (5.0, None)
    assert got[("flat", "a", ten)][1] == 0.0
    assert got[("edge", "a", ten)] == (1.0, None) and got[("edge", "a", twenty)] == (2.0, None)
    assert got[(None, "a", ten)] == (4.0, pytest.approx(math.sqrt(2)))
    assert got[("void", "a", ten)] == (None, None)
    assert got[("half", "a", ten)] == (4.0, None)
    assert math.isnan(got[("nan", "a", ten)][0]) and math.isnan(got[("nan", "a", ten)][1])
    assert not any(key[0] == "notime" for key in got)


def test_flat_window_over_many_slots_has_no_deviation(ticks_of):
    rows = [("A", 0.1, i * S + j) for i in range(50) for j in range(i % 7 + 1)]
    got = got_stats(window_stats(ticks_of(rows), Ladder.of(a=1, b=60)))
    assert got[("A", "b", 60 * S)][1] == 0.0


def test_small_spread_at_large_prices(ticks_of):
    rows = [("A", 1e9 + (i % 2) * 1e-3 + (i // 30) * 1e6, i * S) for i in range(60)]
    got = got_stats(window_stats(ticks_of(rows), Ladder.of(a=10, b=30, c=60)))
    expected = expected_stats(rows, Ladder.of(a=10, b=30, c=60))
    for key, (_, std) in expected.items():
        assert math.isclose(got[key][1], std, rel_tol=1e-3), key


def test_nested_forms_agree_and_are_in_ladder_order(ticks_of):
    ticks = ticks_of(random_ticks(5))
    ladder = Ladder.of(z=3, m=6, a=12)
    direct = {(r.symbol, r.timestamp): r.stats for r in nested_window_stats(ticks, ladder).collect()}
    again = {(r.symbol, r.timestamp): r.stats for r in nest_stats(window_stats(ticks, ladder), ladder).collect()}
    assert direct.keys() == again.keys()
    for key in direct:
        labels = [s.window for s in direct[key]]
        assert labels == [s.window for s in again[key]] == [x for x in ["z", "m", "a"] if x in labels]
    assert_close(got_stats(unnest_stats(nested_window_stats(ticks, ladder))), got_stats(window_stats(ticks, ladder)))


def test_wire_leaves_out_null_deviation(ticks_of, spark):
    wire = to_wire(nested_window_stats(ticks_of([("A", 5, 1)]), Ladder.of(a=30)))
    value = json.loads(wire.first().value)
    assert value == {"timestamp": "1970-01-01T00:00:30.000Z", "symbol": "A", "stats": [{"window": "a", "avg_price": 5.0}]}
    back = unnest_stats(from_wire(wire, WINDOW_STATS_WIRE)).first()
    assert (back.avg_price, back.std_price) == (5.0, None)


def test_unnest_drops_null_and_empty(spark):
    rows = spark.createDataFrame([(None, "A", None), (None, "B", [])], WINDOW_STATS_WIRE)
    assert unnest_stats(rows).count() == 0


def scored(df):
    rows = df.select("symbol", "window", F.unix_micros("timestamp").alias("us"), "price", "zscore_price").collect()
    return {(r.symbol, r.window, r.us): (r.price, r.zscore_price) for r in rows}


@pytest.mark.parametrize("ladder, grain", [(SMALL, 1), (SMALL, 3), (UNEVEN, 1), (SMALL, 2), (Ladder.of(a=4), 4)])
def test_scores_in_one_scan_equal_the_join(ticks_of, ladder, grain):
    ticks = ticks_of(random_ticks(6, n=300) + [(None, 1, 3 * S), ("B", None, 6 * S)])
    joined = score(second_price(ticks, grain), window_stats(ticks, ladder))
    assert_close(scored(zscores(ticks, ladder, grain)), scored(joined))
    assert len(scored(joined)) > 5


def test_score_edges(ticks_of):
    ladder = Ladder.of(a=10)
    rows = [
        ("lone", 5, 1), ("lone", 9, 10 * S),                          # null deviation: 0
        ("flat", 2, 1), ("flat", 2, 2), ("flat", 9, 10 * S),          # deviation 0: 0
        ("miss", 1, 1), ("miss", 3, 2), ("miss", 9, 11 * S),          # no tick in the boundary second
        ("hit", 1, 1), ("hit", 3, 2), ("hit", 4, 10 * S), ("hit", 6, 11 * S - 1),
        ("nan", "nan", 1), ("nan", 1, 2), ("nan", 4, 10 * S),
        ("void", 1, 1), ("void", 3, 2), ("void", None, 10 * S),       # null price, real deviation
        ("none", 1, 1), ("none", None, 10 * S),                       # null price, null deviation
    ]
    got = {k[0]: v for k, v in scored(zscores(ticks_of(rows), ladder)).items() if k[2] == 10 * S}
    assert got["lone"] == (9.0, 0.0) and got["flat"] == (9.0, 0.0)
    assert "miss" not in got
    assert got["hit"] == (5.0, pytest.approx(3 / math.sqrt(2)))
    assert math.isnan(got["nan"][1])
    assert got["void"] == (None, None)
    assert got["none"] == (None, 0.0)


def test_nested_scores_agree(ticks_of):
    ticks = ticks_of(random_ticks(7))
    direct = nested_zscores(ticks, SMALL)
    again = nest_scores(zscores(ticks, SMALL), SMALL)

    def flat(df):
        return {(r.symbol, r.window, r.timestamp): (r.zscore_price,) for r in unnest_scores(df).collect()}
    assert_close(flat(direct), flat(again))


def test_one_scan_and_two_shuffles(spark, ticks_of, tmp_path):
    path = str(tmp_path / "ticks")
    ticks_of(random_ticks(8)).write.parquet(path)
    ticks = spark.read.parquet(path)
    for df in (window_stats(ticks), nested_window_stats(ticks), zscores(ticks), nested_zscores(ticks)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_ladder_rejects_nonsense():
    for widths in ({}, {"a": 0}, {"a": 5, "b": 5}):
        with pytest.raises(ValueError):
            Ladder.from_dict(widths)
    assert (LADDER.slot, LADDER.block, LADDER.labels) == (30, 3600, ["30s", "1m", "5m", "15m", "30m", "1h"])
