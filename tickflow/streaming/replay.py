"""Play a finished table through a streaming query, to its last row.

The table is landed in steps of event time and the query is run to the end of
each step, resuming from its checkpoint, so it sees ordered micro-batches and
restarts. The last step carries one tick far in the future on a symbol of its
own, which moves the watermark past everything else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickflow.files import Files
from tickflow.functions.timeline import from_micros, micros, time_type
from tickflow.session import scratch_dir, stream_settings
from tickflow.sinks.write import run_to_end
from tickflow.sources.ticks import read_records, ticks_as_records

FLUSH_SYMBOL = "~flush"
_FLUSH_AFTER_DAYS = 3650


def replay_ticks(
    spark: SparkSession, ticks: DataFrame, start: Callable[[DataFrame, str], StreamingQuery],
    steps: int = 2, flush_twice: bool = False, partitions: int | None = None,
) -> None:
    """`start(records, checkpoint)` gets a stream of wire records and starts the query.

    `partitions` is the number of state partitions, the session's if not given.
    `flush_twice` adds a second, later flush tick, for queries whose output
    feeds another one that has to be flushed as well. What was landed and the
    checkpoint are removed at the end.
    """
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "checkpoint")
    as_type = time_type(ticks, "timestamp")
    us = micros(F.col("timestamp"))
    ends = ticks.agg(F.min(us).alias("first"), F.max(us).alias("last")).first()
    cuts = [
        from_micros(F.lit(ends["first"] + (ends["last"] - ends["first"]) * i // steps), as_type)
        for i in range(steps)
    ]
    for step in range(steps):
        part = ticks
        if step > 0:
            part = part.filter(F.col("timestamp") >= cuts[step])
        if step < steps - 1:
            part = part.filter(F.col("timestamp") < cuts[step + 1])
        else:
            part = part.unionByName(flush_tick(ticks))
        _run_on(spark, part, landing, checkpoint, start, partitions)
    if flush_twice:
        _run_on(spark, flush_tick(ticks, times=2), landing, checkpoint, start, partitions)
    for folder in (landing, checkpoint):
        Files(spark).remove(folder)


def _run_on(spark, part: DataFrame, landing: str, checkpoint: str, start, partitions: int | None) -> None:
    ticks_as_records(part).write.mode("append").text(landing)
    with stream_settings(spark, partitions):
        run_to_end(start(read_records(spark, "text", landing, stream=True), checkpoint))


def flush_tick(ticks: DataFrame, times: int = 1) -> DataFrame:
    """One tick on `FLUSH_SYMBOL`, `times` flush spans after the last of `ticks`."""
    later = F.make_dt_interval(F.lit(_FLUSH_AFTER_DAYS * times))
    return ticks.agg(F.max("timestamp").alias("last")).select(
        F.lit(FLUSH_SYMBOL).alias("symbol"), F.lit(0.0).alias("price"), (F.col("last") + later).alias("timestamp"))
