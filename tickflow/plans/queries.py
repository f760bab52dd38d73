"""Registered queries: each takes (spark, sf_dir), reads whole tables and returns a DataFrame.

Doubles are rounded the same way here and in the SQL of `plans.oracle`: a small
shift keeps means that end in an exact half from rounding either way.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.operators import ingest
from tickflow.operators.ladder import nest_stats, nested_window_stats, unnest_stats, window_stats
from tickflow.operators.shifts import HIGHER, LOWER, price_shifts, shift_events, shift_messages
from tickflow.operators.zscore import nested_zscores, score, unnest_scores, zscores
from tickflow.plans.jobs import End, start_ingest
from tickflow.schemas import LADDER, LADDER_SCALED, WINDOW_STATS_WIRE, ZSCORES_WIRE, Ladder
from tickflow.session import scratch_dir, stream_settings, tune
from tickflow.sinks.handover import handed_over, ledger_of
from tickflow.sinks.write import read_routes, route_by, route_stream, run_to_end, to_wire, write_batch, write_stream
from tickflow.sources.ticks import events_as_ticks, read_records, ticks_as_records
from tickflow.streaming.ladder import (
    SLOTS_SCHEMA, slot_moments_stream, streaming_nested_stats, window_stats_from_slots,
)
from tickflow.streaming.replay import FLUSH_SYMBOL, flush_tick, replay_ticks
from tickflow.streaming.shifts import streaming_price_shifts
from tickflow.streaming.zscore import streaming_nested_scores

HOUR = 3600
DAY = 86400
LONG_HORIZON = 7200
_STATE = 2  # state partitions of the replayed streams, which are small

Query = Callable[[SparkSession, str], DataFrame]


def rounded(value: Column) -> Column:
    return F.round(value + F.lit(1e-9), 6) + F.lit(0.0)


def _tidy(df: DataFrame, *doubles: str) -> DataFrame:
    """Plain timestamps and rounded doubles."""
    out = df.withColumns({d: rounded(F.col(d)) for d in doubles})
    if "timestamp" in df.columns:
        out = out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return out


def _ticks(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return events_as_ticks(tune(spark), sf_dir, *extra)


def _no_flush(df: DataFrame) -> DataFrame:
    return df.filter(F.col("symbol") != FLUSH_SYMBOL)


# --- ingest ------------------------------------------------------------------

def tick_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidy(ingest.parse_ticks(ticks_as_records(_ticks(spark, sf_dir))))


def tick_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validate, publish as wire records, read back, parse."""
    records = ticks_as_records(_ticks(spark, sf_dir))
    path = scratch_dir(spark, "published")
    write_batch(ingest.good(ingest.validate_ticks(records)).select("value"), "text", path)
    return _tidy(ingest.parse_ticks(read_records(spark, "text", path)))


def tick_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of eight tables, and ticks with text behind them, taken for tick records; records per verdict."""
    def symbol_and_price(symbol: str, price: str) -> Column:
        return F.to_json(F.struct(F.col(symbol).alias("symbol"), F.col(price).alias("price")))

    texts = {
        "documents": F.col("text"), "conversations": F.col("text"),
        "pages": F.col("html"), "benchmark": F.col("text"), "embeddings": F.to_json("embedding"),
        "orders": symbol_and_price("o_orderstatus", "o_orderpriority"),
        "lineitem": symbol_and_price("l_partkey", "l_extendedprice"),
    }
    # Good records, the same with text that closes an array they are put in and goes on behind it, and other texts of events.
    props = F.struct(F.col("props").alias("value"), F.lit("events").alias("origin"))
    ticks = [F.struct(F.concat("value", F.lit(end)).alias("value"), F.lit(f"ticks{end}").alias("origin")) for end in ("", "]x", ",0]", "],[0")]
    events = ticks_as_records(_ticks(spark, sf_dir, "props"), "props").select(F.explode(F.array(props, *ticks)).alias("text")).select("text.*")
    inputs = [events] + [
        spark.read.parquet(f"{sf_dir}/{table}.parquet").select(text.alias("value"), F.lit(table).alias("origin"))
        for table, text in texts.items()
    ]
    judged = ingest.validate_ticks(reduce(DataFrame.unionByName, inputs))
    verdict = F.coalesce("reject_reason", F.lit("good")).alias("verdict")
    return judged.groupBy("origin", verdict).agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.col("non_finite").cast("long")).alias("non_finite"))


def tick_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwriting puts now on every tick; filling keeps what is there."""
    ticks = _ticks(spark, sf_dir, "event_id")
    stamped = ingest.stamp_event_time(ticks.withColumn("sent", F.col("timestamp")))
    filled = ingest.stamp_event_time(stamped.withColumn("kept", F.col("sent")), "fill", "kept")
    is_now = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("timestamp")) < 86400
    return filled.select("event_id", is_now.alias("stamped_now"), F.col("kept").cast("timestamp_ntz").alias("kept"))


def tick_second_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidy(ingest.second_price(_ticks(spark, sf_dir)), "price")


def tick_hour_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidy(ingest.second_price(_ticks(spark, sf_dir), HOUR), "price")


# --- window ladder -----------------------------------------------------------

def _window_stats(ladder: Ladder) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _tidy(window_stats(_ticks(spark, sf_dir), ladder), "avg_price", "std_price")
    return query


def window_stats_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = nested_window_stats(_ticks(spark, sf_dir), LADDER)
    return _tidy(nested.select("timestamp", "symbol", F.array_join("stats.window", ",").alias("windows")))


def window_stats_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested, as JSON and back."""
    wire = to_wire(nested_window_stats(_ticks(spark, sf_dir), LADDER_SCALED))
    return _tidy(unnest_stats(ingest.from_wire(wire, WINDOW_STATS_WIRE)), "avg_price", "std_price")


# --- z-score -----------------------------------------------------------------

_SCORE_DOUBLES = ("price", "avg_price", "std_price", "zscore_price")


def _zscores(ladder: Ladder, grain: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _tidy(zscores(_ticks(spark, sf_dir), ladder, grain), *_SCORE_DOUBLES)
    return query


def zscore_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices joined to statistics, as for statistics that are stored already."""
    ticks = _ticks(spark, sf_dir)
    joined = score(ingest.second_price(ticks, HOUR), window_stats(ticks, LADDER_SCALED))
    return _tidy(joined, *_SCORE_DOUBLES)


def window_stats_nested_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested and taken apart again, with the values."""
    return _tidy(unnest_stats(nested_window_stats(_ticks(spark, sf_dir))), "avg_price", "std_price")


def zscore_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = nested_zscores(_ticks(spark, sf_dir), LADDER_SCALED, HOUR)
    return _tidy(nested.select("timestamp", "symbol", F.array_join("zscores.window", ",").alias("windows")))


def zscore_unnested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested, as JSON and back to one document per window."""
    wire = to_wire(nested_zscores(_ticks(spark, sf_dir), LADDER_SCALED, HOUR))
    return _tidy(unnest_scores(ingest.from_wire(wire, ZSCORES_WIRE)), "zscore_price")


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written to one folder per window, then counted from there."""
    path = scratch_dir(spark, "routes")
    documents = zscores(_ticks(spark, sf_dir), LADDER_SCALED, HOUR).select("timestamp", "symbol", "window", "zscore_price")
    route_by(documents, "window", path)
    return read_routes(spark, "window", path, documents.schema).groupBy("window").agg(F.count(F.lit(1)).alias("documents"))


# --- price shift -------------------------------------------------------------

def _price_shift(horizon: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return price_shifts(_ticks(spark, sf_dir, "event_id"), horizon).select(
            "event_id", "higher_window", "higher_found", "lower_window", "lower_found")
    return query


def price_shift_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In many pieces, so that most ticks are near the edge of one."""
    return price_shifts(_ticks(spark, sf_dir, "event_id"), LONG_HORIZON, pieces=64).select(
        "event_id", "higher_window", "higher_found", "lower_window", "lower_found")


def price_shift_rising(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of prices that only ever rise, in many pieces."""
    rising = _ticks(spark, sf_dir, "event_id").withColumn("price", F.col("event_id").cast("double"))
    return price_shifts(rising, LONG_HORIZON, pieces=64).select(
        "event_id", "higher_window", "higher_found", "lower_window", "lower_found")


def price_shift_null_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where prices are missing: such ticks neither ask nor answer."""
    ticks = _ticks(spark, sf_dir, "event_id").withColumn("price", F.when(F.col("price") >= 50, F.col("price")))
    return price_shifts(ticks, LONG_HORIZON).select(
        "event_id", "higher_window", "higher_found", "lower_window", "lower_found")


def _first(kind: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = shift_events(price_shifts(_ticks(spark, sf_dir), LONG_HORIZON))
        return _tidy(events.filter(F.col("kind") == kind).drop("kind"))
    return query


def price_shift_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shift_messages(shift_events(price_shifts(_ticks(spark, sf_dir), LONG_HORIZON)))


# --- streams, played to their end ----------------------------------------------

def _raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks on the wire, and texts of events and orders that are none."""
    props = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("props").alias("value"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_json(F.struct(
        F.col("o_orderstatus").alias("symbol"), F.col("o_orderpriority").alias("price"))).alias("value"))
    return ticks_as_records(_ticks(spark, sf_dir)).unionByName(props).unionByName(orders)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records validated, stamped and published, the rejected ones kept: records per outcome."""
    raw, published, rejected = (scratch_dir(spark, n) for n in ("raw", "published", "rejected"))
    write_batch(_raw_records(spark, sf_dir), "text", raw)
    run_to_end(start_ingest(
        spark, End("text", raw), End("text", published), End("text", rejected), scratch_dir(spark, "checkpoint"),
        available_now=True))
    good = ingest.parse_ticks(read_records(spark, "text", published)).filter(
        F.col("price").isNotNull() & F.col("timestamp").isNotNull()).select(F.lit("good").alias("outcome"))
    bad = read_records(spark, "text", rejected).select(F.get_json_object("value", "$.reject_reason").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("records"))


def stream_ingest_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is published of raw records: symbols and prices, and how often."""
    raw, published, rejected = (scratch_dir(spark, n) for n in ("raw", "published", "rejected"))
    write_batch(ticks_as_records(_ticks(spark, sf_dir)), "text", raw)
    run_to_end(start_ingest(
        spark, End("text", raw), End("text", published), End("text", rejected), scratch_dir(spark, "checkpoint"),
        available_now=True))
    ticks = ingest.parse_ticks(read_records(spark, "text", published))
    return ticks.groupBy("symbol", rounded(F.col("price")).alias("price")).agg(F.count(F.lit(1)).alias("records"))


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest that is stopped at every step of a hand-over and started again: rows seen and rows committed per output."""
    raw, published, rejected, checkpoint = (scratch_dir(spark, n) for n in ("raw", "published", "rejected", "checkpoint"))
    records = _raw_records(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(5)))
    steps = [None, "good aside", "rejected aside", "committed", "good seen"]

    def ingest_until(step: str | None) -> None:
        def stop(done: str) -> None:
            if done == step:
                raise RuntimeError(f"stopped after: {step}")
        run_to_end(start_ingest(
            spark, End("text", raw), End("text", published), End("text", rejected), checkpoint, available_now=True, at_step=stop))

    for part, step in enumerate(steps):
        write_batch(records.filter(F.col("part") == part).select("value"), "text", raw)
        try:
            ingest_until(step)
        except StreamingQueryException:
            ingest_until(None)
    seen = read_records(spark, "text", published).select(F.lit("good").alias("output")).unionByName(
        read_records(spark, "text", rejected).select(F.lit("rejected").alias("output")))
    committed = handed_over(spark, ledger_of(checkpoint)).groupBy("output").agg(F.sum("rows").alias("committed"))
    return seen.groupBy("output").agg(F.count(F.lit(1)).alias("records")).join(committed, "output", "full")


def stream_late_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick comes once more, with another price, after the watermark has passed it."""
    landing, checkpoint, out = (scratch_dir(spark, n) for n in ("landing", "checkpoint", "prices"))
    ticks = _ticks(spark, sf_dir)
    for part in (ticks, flush_tick(ticks), ticks.withColumn("price", F.col("price") + 1), flush_tick(ticks, times=2)):
        ticks_as_records(part).write.mode("append").text(landing)
        with stream_settings(spark, partitions=_STATE):
            prices = ingest.second_price(ingest.parse_ticks(read_records(spark, "text", landing, stream=True)), HOUR)
            run_to_end(write_stream(prices, checkpoint, "parquet", out, available_now=True))
    return _tidy(_no_flush(spark.read.parquet(out)), "price")


def stream_hour_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "prices")

    def start(records: DataFrame, checkpoint: str):
        prices = ingest.second_price(ingest.parse_ticks(records), HOUR)
        return write_stream(prices, checkpoint, "parquet", out, available_now=True)

    replay_ticks(spark, _ticks(spark, sf_dir), start, steps=2, partitions=_STATE)
    return _tidy(_no_flush(spark.read.parquet(out)), "price")


def stream_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks to nested statistics on the wire, in one read and one stateful step."""
    out = scratch_dir(spark, "stats")

    def start(records: DataFrame, checkpoint: str):
        wire = to_wire(streaming_nested_stats(ingest.parse_ticks(records), LADDER_SCALED))
        return write_stream(wire, checkpoint, "text", out, available_now=True)

    replay_ticks(spark, _ticks(spark, sf_dir), start, steps=2, partitions=_STATE)
    nested = ingest.from_wire(read_records(spark, "text", out), WINDOW_STATS_WIRE)
    return _tidy(_no_flush(unnest_stats(nested)), "avg_price", "std_price")


def stream_window_stats_from_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from two queries: ticks to slots, slots to all windows."""
    landed, checkpoint, out = (scratch_dir(spark, n) for n in ("slots", "checkpoint", "stats"))

    def start(records: DataFrame, slots_checkpoint: str):
        slots = slot_moments_stream(ingest.parse_ticks(records), LADDER_SCALED)
        return write_stream(slots, slots_checkpoint, "parquet", landed, available_now=True)

    replay_ticks(spark, _ticks(spark, sf_dir), start, steps=2, flush_twice=True, partitions=_STATE)
    with stream_settings(spark, partitions=_STATE):
        slots = spark.readStream.schema(SLOTS_SCHEMA).parquet(landed)
        stats = window_stats_from_slots(slots, LADDER_SCALED)
        run_to_end(write_stream(stats, checkpoint, "parquet", out, available_now=True))
    return _tidy(_no_flush(spark.read.parquet(out)), "avg_price", "std_price")


def stream_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks joined to the stream of statistics: aggregate, join, aggregate."""
    ticks = _ticks(spark, sf_dir)
    stats_in, out = scratch_dir(spark, "stats"), scratch_dir(spark, "scores")
    flushed = ticks.unionByName(flush_tick(ticks))
    write_batch(
        to_wire(nest_stats(window_stats(flushed, LADDER_SCALED), LADDER_SCALED)), "text", stats_in)

    def start(records: DataFrame, checkpoint: str):
        wire_stats = read_records(spark, "text", stats_in, stream=True)
        stats = unnest_stats(ingest.from_wire(wire_stats, WINDOW_STATS_WIRE))
        nested = streaming_nested_scores(ingest.parse_ticks(records), stats, LADDER_SCALED, HOUR)
        return write_stream(to_wire(nested), checkpoint, "text", out, available_now=True)

    replay_ticks(spark, ticks, start, steps=1, partitions=_STATE)
    nested = ingest.from_wire(read_records(spark, "text", out), ZSCORES_WIRE)
    return _tidy(_no_flush(unnest_scores(nested)), "zscore_price")


def stream_zscore_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streaming jobs by turns, each over several restarts: statistics from ticks, scores from both."""
    ticks = _ticks(spark, sf_dir)
    stats_in, out = scratch_dir(spark, "stats"), scratch_dir(spark, "scores")

    def start(records: DataFrame, checkpoint: str):
        parsed = ingest.parse_ticks(records)
        per_window = to_wire(streaming_nested_stats(parsed, LADDER_SCALED))
        run_to_end(write_stream(per_window, f"{checkpoint}-stats", "text", stats_in, available_now=True))
        stats = unnest_stats(ingest.from_wire(read_records(spark, "text", stats_in, stream=True), WINDOW_STATS_WIRE))
        nested = streaming_nested_scores(parsed, stats, LADDER_SCALED, HOUR)
        return write_stream(to_wire(nested), checkpoint, "text", out, available_now=True)

    replay_ticks(spark, ticks, start, steps=2, flush_twice=True, partitions=_STATE)
    nested = ingest.from_wire(read_records(spark, "text", out), ZSCORES_WIRE)
    return _tidy(_no_flush(unnest_scores(nested)), "zscore_price")


def _stream_price_shift(emit: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = scratch_dir(spark, "shifts")

        def start(records: DataFrame, checkpoint: str):
            shifts = streaming_price_shifts(ingest.parse_ticks(records), LONG_HORIZON, emit=emit)
            return write_stream(shifts, checkpoint, "parquet", out, available_now=True)

        replay_ticks(spark, _ticks(spark, sf_dir), start, steps=2, partitions=4 * _STATE)
        return _tidy(_no_flush(spark.read.parquet(out)).drop("price"))
    return query


def stream_price_shift_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh tick comes when all others have been seen: kept where its slot still waits, else counted as late."""
    landing, checkpoint, out = (scratch_dir(spark, n) for n in ("landing", "checkpoint", "shifts"))
    ticks = _ticks(spark, sf_dir, "event_id")
    behind = F.col("event_id") % 7 == 3
    for part in (ticks.filter(~behind), ticks.filter(behind), flush_tick(ticks)):
        ticks_as_records(part).write.mode("append").text(landing)
        with stream_settings(spark, partitions=4 * _STATE):
            shifts = streaming_price_shifts(
                ingest.parse_ticks(read_records(spark, "text", landing, stream=True)), DAY, late="keep")
            run_to_end(write_stream(shifts, checkpoint, "parquet", out, available_now=True))
    return _tidy(_no_flush(spark.read.parquet(out)).drop("price"))


def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One streaming query that writes every window's documents to its own folder."""
    ticks = _ticks(spark, sf_dir)
    scores_in, out = scratch_dir(spark, "scores"), scratch_dir(spark, "routes")
    write_batch(to_wire(nested_zscores(ticks, LADDER_SCALED, HOUR)), "text", scores_in)
    nested = ingest.from_wire(read_records(spark, "text", scores_in, stream=True), ZSCORES_WIRE)
    documents = unnest_scores(nested)
    run_to_end(route_stream(documents, "window", out, scratch_dir(spark, "checkpoint"), available_now=True))
    return _tidy(read_routes(spark, "window", out, documents.schema), "zscore_price").select(
        "timestamp", "symbol", "window", "zscore_price")


QUERIES: dict[str, Query] = {
    "tick_parse": tick_parse,
    "tick_publish": tick_publish,
    "tick_validate": tick_validate,
    "tick_stamp": tick_stamp,
    "tick_second_price": tick_second_price,
    "tick_hour_price": tick_hour_price,
    "window_stats_default": _window_stats(LADDER),
    "window_stats_scaled": _window_stats(LADDER_SCALED),
    "window_stats_nested": window_stats_nested,
    "window_stats_nested_values": window_stats_nested_values,
    "window_stats_wire": window_stats_wire,
    "zscore_default": _zscores(LADDER, 1),
    "zscore_scaled": _zscores(LADDER_SCALED, HOUR),
    "zscore_joined": zscore_joined,
    "zscore_nested": zscore_nested,
    "zscore_unnested": zscore_unnested,
    "route_counts": route_counts,
    "price_shift_20s": _price_shift(20),
    "price_shift_7200s": _price_shift(LONG_HORIZON),
    "price_shift_split": price_shift_split,
    "price_shift_rising": price_shift_rising,
    "price_shift_null_prices": price_shift_null_prices,
    "first_higher": _first(HIGHER),
    "first_lower": _first(LOWER),
    "price_shift_messages": price_shift_messages,
    "stream_ingest": stream_ingest,
    "stream_ingest_ticks": stream_ingest_ticks,
    "stream_hour_price": stream_hour_price,
    "stream_replay": stream_replay,
    "stream_late_ticks": stream_late_ticks,
    "stream_window_stats": stream_window_stats,
    "stream_window_stats_from_slots": stream_window_stats_from_slots,
    "stream_zscore": stream_zscore,
    "stream_zscore_chained": stream_zscore_chained,
    "stream_price_shift": _stream_price_shift("final"),
    "stream_price_shift_eager": _stream_price_shift("eager"),
    "stream_price_shift_late": stream_price_shift_late,
    "stream_route": stream_route,
}
