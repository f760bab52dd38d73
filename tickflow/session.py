"""Session settings the operators are written for."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# SQL settings, all changeable on a running session.
SETTINGS = {
    # Windows are aligned to the epoch, and NTZ columns are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # A record that names a field twice is read with the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Slots multiply after the shuffle, so small shuffles still go to all cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
}

# State off the heap, with checkpoints of what changed.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply `SETTINGS` to a session; partition counts stay as the cluster has them."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def stream_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings to start a stateful query with; the session has its own back afterwards.

    Every stateful operator commits a store per partition and micro-batch, and
    the number of partitions is fixed for good by the first checkpoint: give the
    number for the life of the query, or the session's is taken.
    """
    wanted = dict(STREAM_SETTINGS)
    if partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one the cluster names in spark.checkpoint.dir.

    Where none is named, a local temporary folder on one machine (tests), and
    an error on a cluster, whose machines would not see each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("name a folder that all machines share in spark.checkpoint.dir")
    return tempfile.mkdtemp(prefix=f"{name}-")
