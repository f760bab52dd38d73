import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickflow.operators import ingest
from tickflow.sources.ticks import ticks_as_records

GOOD = '{"symbol":"A","price":"94321.01000000","timestamp":"2025-04-30T12:00:00.123456+00:00"}'


def records(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_reads_text_price_and_micros(spark):
    row = ingest.parse_ticks(records(spark, [GOOD])).first()
    assert (row.symbol, row.price) == ("A", 94321.01)
    us = ingest.parse_ticks(records(spark, [GOOD])).select(F.unix_micros("timestamp")).first()[0]
    assert us == 1746014400123456


def test_parse_takes_numbers_and_bytes(spark):
    as_bytes = records(spark, ['{"symbol":"A","price":1.5,"timestamp":"2025-04-30T12:00:00+00:00"}']).select(
        F.col("value").cast("binary").alias("value"))
    assert ingest.parse_ticks(as_bytes).first().price == 1.5


@pytest.mark.parametrize("value", [
    "not json", None, '{"symbol":"A"}', '{"symbol":"A","price":"abc"}', '{"symbol":"A","price":""}',
    '{"symbol":"A","price":"1_0"}', '{"symbol":"A","price":"1d"}', '{"symbol":"A","price":"0x10"}',
])
def test_malformed_price_is_null_and_no_error(spark, value):
    rows = ingest.parse_ticks(records(spark, [value])).collect()
    assert len(rows) == 1 and rows[0].price is None and rows[0].timestamp is None


def test_malformed_time_is_null(spark):
    row = ingest.parse_ticks(records(spark, ['{"symbol":"A","price":"1","timestamp":"junk"}'])).first()
    assert row.timestamp is None


@pytest.mark.parametrize("value, reason", [
    (GOOD, None),
    ('{"symbol":null,"price":"1"}', None),
    ('{"symbol":7,"price":3}', None),
    ('{"symbol":"A","price":" 2 "}', None),
    ('{"symbol":"A","price":"1e3"}', None),
    ('{"symbol":"A","price":"NaN"}', None),
    ('{"symbol":"A","price":"-Infinity"}', None),
    (None, "empty"), ("", "empty"), ("  ", "empty"), ("null", "empty"), ("{ }", "empty"), ("[]", "empty"),
    ('""', "empty"), ("0", "empty"), ("0.0", "empty"), ("false", "empty"),
    ("not json", "not_json"), ('{"symbol":', "not_json"),
    (GOOD + " tail", "not_json"), (GOOD + GOOD, "not_json"), ("12 words", "not_json"), ("1,2", "not_json"),
    (GOOD + "],[1", "not_json"), (GOOD + "]", "not_json"),
    (" " + GOOD + "\n", None), ('{"symbol":"A","price":"x","price":"2"}', None),
    ("[1]", "not_object"), ("3", "not_object"), ("true", "not_object"), ('"x"', "not_object"),
    ('{"symbol":"A"}', "missing_field"), ('{"price":"1"}', "missing_field"), ('{"a":1}', "missing_field"),
    ('{"symbol":"A","price":"abc"}', "bad_price"), ('{"symbol":"A","price":null}', "bad_price"),
    ('{"symbol":"A","price":[1]}', "bad_price"), ('{"symbol":"A","price":""}', "bad_price"),
    ('{"symbol":"A","price":"1d"}', "bad_price"), ('{"symbol":"A","price":"1_0"}', "bad_price"),
])
def test_reject_reason(spark, value, reason):
    assert ingest.validate_ticks(records(spark, [value])).first().reject_reason == reason


def test_valid_and_quarantined_split(spark):
    judged = ingest.validate_ticks(records(spark, [GOOD, "", "x", "[1]", '{"symbol":"A","price":"inf"}']))
    assert ingest.good(judged).count() == 2
    assert sorted(r.reject_reason for r in ingest.quarantine(judged).collect()) == ["not_json", "not_object"]
    assert judged.filter("non_finite").count() == 1


def test_stamp_modes(spark, ticks_of):
    old = ticks_of([("A", 1, 0), ("A", 2, None)])
    now = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("timestamp")) < 3600
    over = ingest.stamp_event_time(old).select(now.alias("n")).collect()
    assert [r.n for r in over] == [True, True]
    fill = ingest.stamp_event_time(old, "fill").orderBy("price").select(now.alias("n")).collect()
    assert [r.n for r in fill] == [False, True]
    with pytest.raises(ValueError):
        ingest.stamp_event_time(old, "other")


def test_second_price_floors_and_averages(spark, ticks_of):
    rows = ingest.second_price(ticks_of([
        ("A", 1, 0), ("A", 3, 999_999), ("A", 10, 1_000_000), ("A", 5, -1), ("A", None, 2_000_000), ("B", 7, 0),
    ])).select("symbol", F.unix_seconds("timestamp").alias("s"), "price").collect()
    assert {(r.symbol, r.s): r.price for r in rows} == {
        ("A", 0): 2.0, ("A", 1): 10.0, ("A", -1): 5.0, ("A", 2): None, ("B", 0): 7.0}


def test_records_round_trip(spark, ticks_of):
    ticks = ticks_of([("A", 0.1, 1_700_000_000_123_456), ("B", 1e-7, 1_700_000_000_000_000)])
    back = ingest.parse_ticks(ticks_as_records(ticks))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, ticks.collect()))
    assert isinstance(back.first().timestamp, dt.datetime)


def test_text_behind_a_closed_array_is_not_json(spark):
    from tickflow.operators.ingest import validate_ticks
    texts = ['{"symbol":"A","price":"1"},30]', '{"symbol":"A","price":"1"},31]x', '{"symbol":"A","price":"1"}]', '{"symbol":"A","price":"1"}]x',
             '{"symbol":"A","price":"1"},0', '{"symbol":"A","price":"1"}],[0', ' {"symbol":"A","price":"1"} ', '[{"symbol":"A","price":"1"}]']
    got = validate_ticks(spark.createDataFrame([(t,) for t in texts], "value string"))
    reasons = {r.value: r.reject_reason for r in got.collect()}
    assert [reasons[t] for t in texts] == ["not_json"] * 6 + [None, "not_object"]


def test_validation_asks_for_its_setting(spark):
    import pytest
    from tickflow.operators.ingest import validate_ticks
    key = "spark.sql.variant.allowDuplicateKeys"
    spark.conf.set(key, "false")
    try:
        with pytest.raises(ValueError, match=key):
            validate_ticks(spark.createDataFrame([("{}",)], "value string"))
    finally:
        spark.conf.set(key, "true")
