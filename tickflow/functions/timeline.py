"""Event time as whole microseconds since the epoch.

Slot and horizon arithmetic is done on longs: exact, inside code generation,
and the same for TIMESTAMP and TIMESTAMP_NTZ columns. An NTZ column is read as
UTC, so with one the session zone has to be UTC (`require_utc`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.schemas import MICROS

# Instants print with 0, 3 or 6 fraction digits, whichever is exact.
_INSTANT_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
_INSTANT_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
_INSTANT_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


def time_type(df: DataFrame, column: str) -> str:
    """Type name of a time column that `micros` can read in this session."""
    name = df.schema[column].dataType.simpleString()
    if name == "timestamp_ntz":
        require_utc(df.sparkSession)
    return name


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column, as_type: str = "timestamp") -> Column:
    return F.timestamp_micros(us).cast(as_type)


def floor_to(us: Column, seconds: int) -> Column:
    """Start of the epoch-aligned interval that holds `us` (also before 1970)."""
    return us - F.pmod(us, F.lit(seconds * MICROS))


def iso_instant(ts: Column) -> Column:
    us = micros(ts)
    ts = ts.cast("timestamp")
    return (
        F.when(F.pmod(us, F.lit(MICROS)) == 0, F.date_format(ts, _INSTANT_SECONDS))
        .when(F.pmod(us, F.lit(1000)) == 0, F.date_format(ts, _INSTANT_MILLIS))
        .otherwise(F.date_format(ts, _INSTANT_MICROS))
    )
