"""Where ticks come from: any Spark source of JSON records, or the event table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.files import Files
from tickflow.functions.timeline import require_utc
from tickflow.schemas import MICROS

# Fixed value: event time of a tick on the wire.
WIRE_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"

LATEST = "latest"
EARLIEST = "earliest"
Start = str | datetime  # LATEST, EARLIEST or an instant


def read_records(
    spark: SparkSession, fmt: str = "text", path: str | None = None, stream: bool = False,
    options: dict[str, str] | None = None, schema=None, start: Start | None = None, checkpoint: str | None = None,
) -> DataFrame:
    """Raw records with a string column `value`, from a batch or a stream.

    `fmt` and `options` go to Spark as they are (text, json-lines files as
    text, parquet with a `value` column, a message log whose jar is supplied).
    Only `value` is read, so keys and offsets are pruned at the source.

    `start` says where a stream begins when it is first started: with what is
    there (the default for folders), after it (the default for message logs),
    or at an instant. A log source keeps its place in the checkpoint itself; for
    a folder the instant is kept there, so `checkpoint` has to be given.
    """
    merged = {**(_log_start(fmt, start) if stream else {}), **(options or {})}
    reader = (spark.readStream if stream else spark.read).format(fmt).options(**merged)
    if schema is not None:
        reader = reader.schema(schema)
    loaded = reader.load(path) if path is not None else reader.load()
    if stream and path is not None and start not in (None, EARLIEST):
        after = _first_start(spark, path, start, checkpoint)
        # Known before a file is opened: files of history are listed and not read.
        loaded = loaded.filter(F.unix_micros("_metadata.file_modification_time") > after)
    return loaded.select(F.col("value").cast("string").alias("value"))


def _log_start(fmt: str, start: Start | None) -> dict[str, str]:
    if fmt != "kafka":
        return {}
    if isinstance(start, datetime):
        return {"startingTimestamp": str(int(start.timestamp() * 1000))}
    return {"startingOffsets": start or LATEST}


def _first_start(spark: SparkSession, path: str, start: Start, checkpoint: str | None) -> int:
    """Files modified after this instant (microseconds) count; decided when the stream is first started.

    `LATEST` is the time of the newest file that is there, by the store's own clock.
    """
    if checkpoint is None:
        raise ValueError("a folder's start position is kept in the checkpoint: name it")
    files, kept = Files(spark), f"{checkpoint}/start-position"
    if not files.exists(kept):
        if isinstance(start, datetime):
            after = int(start.timestamp() * MICROS) - 1
        elif start == LATEST:
            there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            after = there.agg(F.max(F.unix_micros("modificationTime"))).first()[0] or 0
        else:
            raise ValueError(f"unknown start {start!r}")
        files.write_whole(kept, str(after))
    return int(spark.read.text(kept).first()[0])


def events_as_ticks(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """The `events` table as ticks, with `extra` columns kept (such as event_id)."""
    require_utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        *extra,
        F.col("event_type").alias("symbol"),
        # + 0.0 turns a negative zero into zero
        (F.col("value") + F.lit(0.0)).alias("price"),
        F.col("ts").alias("timestamp"),
    )


def ticks_as_records(ticks: DataFrame, *extra: str) -> DataFrame:
    """Ticks as they arrive on the wire: price as text, time with microseconds."""
    return ticks.select(
        *extra,
        F.to_json(
            F.struct(
                "symbol",
                F.col("price").cast("string").alias("price"),
                F.col("timestamp").cast("timestamp").alias("timestamp"),
            ),
            {"timestampFormat": WIRE_MICROS},
        ).alias("value")
    )
