"""The stages as streaming jobs between two ends, each one query.

An end is anything Spark reads or writes: a topic, a folder, a store whose
connector is on the class path. Sources need a string or binary column `value`;
wire sinks get one. Session settings such as a graceful stop, and the number of
cores of a job, are the caller's.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickflow.operators.ingest import from_wire, good, parse_ticks, quarantine, stamp_event_time, validate_ticks
from tickflow.operators.ladder import unnest_stats
from tickflow.operators.shifts import HIGHER, LOWER, shift_messages
from tickflow.operators.zscore import unnest_scores
from tickflow.schemas import (
    LADDER, LATENESS, PRICE_GRAIN, SHIFT_HORIZON, TICK_WIRE, WINDOW_STATS_WIRE, ZSCORES_WIRE, Ladder,
)
from tickflow.sinks.handover import Step, hand_over_stream
from tickflow.sinks.write import route_stream, to_wire, write_batch, write_stream
from tickflow.sources.ticks import Start, read_records
from tickflow.streaming.ladder import (
    SLOTS_SCHEMA, nested_stats_from_slots, slot_moments_stream, streaming_nested_stats,
)
from tickflow.streaming.shifts import streaming_price_shifts
from tickflow.streaming.zscore import streaming_nested_scores


@dataclass(frozen=True)
class End:
    """A format, and where and how to reach it; `start_at` is where a stream of it begins when first started."""

    fmt: str = "text"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    start_at: Start | None = None

    def stream(self, spark: SparkSession, checkpoint: str | None = None) -> DataFrame:
        return read_records(spark, self.fmt, self.path, stream=True, options=dict(self.options),
                            start=self.start_at, checkpoint=checkpoint)

    def start(self, df: DataFrame, checkpoint: str, available_now: bool, interval: str | None = None) -> StreamingQuery:
        return write_stream(
            df, checkpoint, self.fmt, self.path, dict(self.options), available_now, interval=interval)

    def write(self, df: DataFrame, part: str | None = None) -> None:
        """`part` is a sub-folder of the path; what it holds is replaced."""
        if self.path is None or part is None:
            write_batch(df, self.fmt, self.path, options=dict(self.options))
        else:
            write_batch(df, self.fmt, f"{self.path}/{part}", "overwrite", dict(self.options))


def stamped_records(raw: DataFrame) -> DataFrame:
    """Good raw records as ticks on the wire, with event time set to now."""
    ticks = from_wire(good(raw), TICK_WIRE).select("symbol", "price")
    return to_wire(stamp_event_time(ticks), keep_micros=True)


def start_ingest(
    spark: SparkSession, raw: End, ticks: End, rejected: End, checkpoint: str, available_now: bool = False, interval: str | None = None,
    at_step: Step | None = None,
) -> StreamingQuery:
    """Validate raw price records, stamp and publish the good ones, keep the rejected ones.

    Both outputs of a micro-batch are handed over as one; `handed_over` tells what was published.
    """
    judged = validate_ticks(raw.stream(spark, checkpoint)).withColumn(
        "verdict", F.when(F.col("reject_reason").isNull(), "good").otherwise("rejected"))
    outputs = {
        "good": (ticks, stamped_records),
        "rejected": (rejected, lambda rows: to_wire(quarantine(rows).select("reject_reason", "value"))),
    }
    return hand_over_stream(judged, "verdict", outputs, checkpoint, available_now, interval, at_step)


def start_window_stats(
    spark: SparkSession, ticks: End, stats: End, checkpoint: str, ladder: Ladder = LADDER,
    lateness: int = LATENESS, available_now: bool = False, interval: str | None = None,
) -> StreamingQuery:
    """Ticks to nested window statistics."""
    nested = streaming_nested_stats(parse_ticks(ticks.stream(spark, checkpoint)), ladder, lateness)
    return stats.start(to_wire(nested), checkpoint, available_now, interval)


def start_slot_moments(
    spark: SparkSession, ticks: End, slots_path: str, checkpoint: str, ladder: Ladder = LADDER,
    lateness: int = LATENESS, available_now: bool = False, interval: str | None = None,
) -> StreamingQuery:
    """First half of the window statistics in two jobs, where slots are to be kept."""
    moments = slot_moments_stream(parse_ticks(ticks.stream(spark, checkpoint)), ladder, lateness)
    return write_stream(moments, checkpoint, "parquet", slots_path, available_now=available_now, interval=interval)


def start_window_stats_from_slots(
    spark: SparkSession, slots_path: str, stats: End, checkpoint: str, ladder: Ladder = LADDER,
    available_now: bool = False, interval: str | None = None,
) -> StreamingQuery:
    """Second half: slots to nested window statistics."""
    slots = spark.readStream.schema(SLOTS_SCHEMA).parquet(slots_path)
    return stats.start(to_wire(nested_stats_from_slots(slots, ladder)), checkpoint, available_now, interval)


def start_zscores(
    spark: SparkSession, ticks: End, stats: End, scores: End, checkpoint: str, ladder: Ladder = LADDER,
    grain: int = PRICE_GRAIN, lateness: int = LATENESS, available_now: bool = False, interval: str | None = None,
) -> StreamingQuery:
    """Ticks and window statistics to nested z-scores."""
    per_window = unnest_stats(from_wire(stats.stream(spark, f"{checkpoint}/second"), WINDOW_STATS_WIRE))
    nested = streaming_nested_scores(parse_ticks(ticks.stream(spark, checkpoint)), per_window, ladder, grain, lateness)
    return scores.start(to_wire(nested), checkpoint, available_now, interval)


def start_load(
    spark: SparkSession, scores: End, path: str, checkpoint: str, fmt: str = "parquet", available_now: bool = False, interval: str | None = None,
) -> StreamingQuery:
    """Z-scores to one folder per window."""
    documents = unnest_scores(from_wire(scores.stream(spark, checkpoint), ZSCORES_WIRE))
    return route_stream(documents, "window", path, checkpoint, fmt, available_now, interval)


def start_load_each(
    spark: SparkSession, scores: End, destinations: Mapping[str, End], checkpoint: str, available_now: bool = False, interval: str | None = None,
) -> StreamingQuery:
    """Z-scores to one destination per window, such as a collection each.

    Documents get an `_id` of symbol and time, so that a store which keeps one
    document per id is the same after a replay.
    """
    documents = unnest_scores(from_wire(scores.stream(spark, checkpoint), ZSCORES_WIRE)).withColumn(
        "_id", F.concat_ws("@", "symbol", F.unix_micros("timestamp").cast("string")))
    outputs = {window: (end, lambda rows: rows) for window, end in destinations.items()}
    return hand_over_stream(documents, "window", outputs, checkpoint, available_now, interval)


def start_price_shifts(
    spark: SparkSession, ticks: End, higher: End, lower: End, checkpoint: str, horizon: int = SHIFT_HORIZON,
    lateness: int = LATENESS, emit: str = "final", available_now: bool = False, interval: str | None = None,
) -> StreamingQuery:
    """Ticks to the first higher and the first lower price, one query for both outputs."""
    events = streaming_price_shifts(parse_ticks(ticks.stream(spark, checkpoint)), horizon, lateness, emit=emit)
    outputs = {kind: (end, lambda rows: rows.select("value")) for kind, end in ((HIGHER, higher), (LOWER, lower))}
    return hand_over_stream(shift_messages(events), "kind", outputs, checkpoint, available_now, interval)
