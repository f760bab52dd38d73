"""Writing results: wire records, batch and streaming sinks, routing by a column."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickflow.sources.ticks import WIRE_MICROS


def to_wire(df: DataFrame, keep_micros: bool = False) -> DataFrame:
    """One JSON column `value` per row; null fields are left out.

    Without `keep_micros` times are cut to milliseconds, enough for window ends.
    """
    options = {"timestampFormat": WIRE_MICROS} if keep_micros else {}
    return df.select(F.to_json(F.struct("*"), options).alias("value"))


def write_batch(
    df: DataFrame, fmt: str = "parquet", path: str | None = None, mode: str = "append",
    options: dict[str, str] | None = None,
) -> None:
    writer = df.write.format(fmt).options(**(options or {})).mode(mode)
    if path is None:
        writer.save()
    else:
        writer.save(path)


def write_stream(
    df: DataFrame, checkpoint: str, fmt: str = "parquet", path: str | None = None,
    options: dict[str, str] | None = None, available_now: bool = False, name: str | None = None,
    partition_by: list[str] | None = None, interval: str | None = None,
) -> StreamingQuery:
    """Start an append-mode query. Every sink needs a checkpoint of its own.

    `available_now` works through what is there, in micro-batches, and ends;
    `interval` ("1 minute") starts a micro-batch that often, else one follows the other.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.options(**(options or {}))
    return _start(writer, path, available_now, name, partition_by, interval)


def _start(writer, path=None, available_now=False, name=None, partition_by=None, interval=None) -> StreamingQuery:
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start(path) if path is not None else writer.start()


def balanced(df: DataFrame, column: str) -> DataFrame:
    """Rows of one route together in few files, with large routes on several tasks."""
    return df.hint("rebalance", F.col(column))


def route_by(df: DataFrame, column: str, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """All routes in one pass: one sub-folder per value, so readers of a route prune."""
    balanced(df, column).write.format(fmt).mode(mode).partitionBy(column).save(path)


def read_routes(spark: SparkSession, column: str, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """What `route_by` or `route_stream` wrote. Routes keep the type they were written with: `1d` stays a label."""
    return spark.read.format(fmt).schema(schema).load(path).select(*schema.names)


def route_stream(
    df: DataFrame, column: str, path: str, checkpoint: str, fmt: str = "parquet", available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """One query for all routes, instead of one query and one read of the source each: one sub-folder per value.

    The file sink's log says which files belong to a finished micro-batch, so a
    replay after a failure adds nothing for readers, batch or stream.
    """
    return write_stream(df, checkpoint, fmt, path, available_now=available_now, partition_by=[column], interval=interval)


def route_stream_each(
    df: DataFrame, column: str, routes: list[str], write_route: Callable[[DataFrame, str, int], None],
    checkpoint: str, available_now: bool = False, interval: str | None = None,
) -> StreamingQuery:
    """For sinks with one destination per value (a collection, a topic, a table).

    A row whose value is none of `routes` makes the query fail, before anything is written.

    The micro-batch is computed once, kept, and handed to `write_route(rows,
    route, batch_id)` per route; the batch id lets the writer recognise a replay.
    """
    def write(batch: DataFrame, counts: Mapping[str, int], batch_id: int) -> None:
        for route in routes:
            write_route(batch.filter(F.col(column) == route), route, batch_id)
    return each_batch(df, column, routes, write, checkpoint, available_now, interval)


def each_batch(
    df: DataFrame, column: str, routes: list[str], write_all: Callable[[DataFrame, Mapping[str, int], int], None],
    checkpoint: str, available_now: bool = False, interval: str | None = None,
) -> StreamingQuery:
    """Micro-batches, computed once and kept, with the number of rows of each route; a row of no route is an error."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            known = F.coalesce(F.col(column).isin(routes), F.lit(False))
            found = batch.agg(
                F.sum((~known).cast("long")).alias("lost"), F.first(F.when(~known, F.struct(column)), ignorenulls=True).alias("one"),
                *(F.count_if(F.col(column) == route).alias(f"_{i}") for i, route in enumerate(routes))).first()
            if found["lost"]:
                raise ValueError(f"no destination for {column} = {found['one'][0]!r}")
            write_all(batch, {route: found[f"_{i}"] for i, route in enumerate(routes)}, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer, available_now=available_now, interval=interval)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an `available_now` query; raises what made it fail."""
    query.awaitTermination()


class Ended(NamedTuple):
    """A query that is over, with what made it fail (or None)."""

    name: str | None
    id: str
    error: str | None


def await_any(
    spark: SparkSession, queries: Sequence[StreamingQuery] | None = None, stop_others: bool = True, every: float = 0.5,
) -> list[Ended]:
    """Block until one of the queries (all running ones, if not given) ends or fails; say which, and stop the others.

    Several may be over at once. Without `stop_others` the rest goes on.
    """
    watched = list(spark.streams.active if queries is None else queries)
    if not watched:
        raise ValueError("no query is running")
    while all(query.isActive for query in watched):
        time.sleep(every)
    over = [query for query in watched if not query.isActive]
    failures = [query.exception() for query in over]
    if stop_others:
        for query in watched:
            query.stop()
    return [Ended(query.name, query.id, failure and str(failure)) for query, failure in zip(over, failures)]
