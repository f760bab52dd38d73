"""From raw records to ticks: parse, validate, stamp, average per second."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.timeline import floor_to, from_micros, micros, time_type
from tickflow.schemas import LATENESS, PRICE_GRAIN, TICK_WIRE

# Reasons of `validate_ticks`.
EMPTY = "empty"
NOT_JSON = "not_json"
NOT_OBJECT = "not_object"
MISSING_FIELD = "missing_field"
BAD_PRICE = "bad_price"

# A cast to double also takes a trailing type letter or a hex
# literal, which are no decimal numbers.
_NOT_DECIMAL = r"(?i)([0-9.][df]\s*$|^\s*[+-]?0x)"
# JSON texts that hold nothing.
_HOLLOW = r'(?s)^\s*(null|false|""|\{\s*\}|\[\s*\]|-?0+(\.0+)?([eE][+-]?[0-9]+)?)?\s*$'


def price_of(text: Column) -> Column:
    """Price text as a double; null instead of an error for anything else."""
    return F.when(~text.rlike(_NOT_DECIMAL), text.try_cast("double"))


def from_wire(records: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Rows of a JSON column, one column per field of the schema."""
    return records.select(F.from_json(F.col(value).cast("string"), schema).alias("data")).select("data.*")


def parse_ticks(records: DataFrame, value: str = "value") -> DataFrame:
    """`symbol, price, timestamp` of every record; malformed parts are null."""
    parsed = from_wire(records, TICK_WIRE, value)
    return parsed.select("symbol", price_of(F.col("price")).alias("price"), "timestamp")


def require_duplicate_keys(spark: SparkSession) -> None:
    """A record that names a field twice is read with the last value only under this setting."""
    key = "spark.sql.variant.allowDuplicateKeys"
    if spark.conf.get(key) != "true":
        raise ValueError(f"{key} must be true; tickflow.session.tune sets it")


def validate_ticks(records: DataFrame, value: str = "value") -> DataFrame:
    """Every record with `reject_reason` (null = good) and `non_finite`.

    A good record is a JSON object that has a symbol (of any type) and a price
    that reads as a number. NaN and infinity pass, marked by `non_finite`.

    Each record is parsed once, as the first element of an array whose second
    and last is a random word drawn here. The parser stops after the first value
    of a text, so a record with more text behind it would pass on its own; in
    the array, whatever it goes on with stands where the word should be, and no
    record can know the word.
    """
    require_duplicate_keys(records.sparkSession)
    word = secrets.token_hex(16)
    verdict = _once(F.col(value).cast("string"), lambda text: _verdict(text, word))
    judged = records.withColumn("_verdict", verdict)
    return judged.withColumns({
        "reject_reason": F.col("_verdict.reason"), "non_finite": F.col("_verdict.non_finite")}).drop("_verdict")


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also where a filter on the result moves below other steps."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def _verdict(text: Column, word: str) -> Column:
    hollow = text.isNull() | text.rlike(_HOLLOW)

    def judge(array: Column) -> Column:
        def has(field: str) -> Column:
            # A field that holds JSON null is there.
            return F.try_variant_get(array, f"$[0].{field}", "variant").isNotNull()

        def by_price(price: Column) -> Column:
            is_object = text.rlike(r"^\s*\{")
            alone = F.coalesce(F.try_variant_get(array, "$[1]", "string") == word, F.lit(False))
            reason = (
                F.when(price.isNotNull() & alone & has("symbol"), F.lit(None))
                .when(hollow, EMPTY)
                .when(~alone, NOT_JSON)
                .when(~(has("symbol") & has("price")), F.when(is_object, MISSING_FIELD).otherwise(NOT_OBJECT))
                .otherwise(BAD_PRICE)
            )
            odd = F.isnan(price) | (F.abs(price) == F.lit(float("inf")))
            return _once(reason, lambda r: F.struct(
                r.alias("reason"), F.coalesce(r.isNull() & odd, F.lit(False)).alias("non_finite")))
        return _once(price_of(F.try_variant_get(array, "$[0].price", "string")), by_price)

    # Most records are good, and these need no look at the text itself.
    return _once(F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{word}"]'))), judge)


def good(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNull()).drop("reject_reason", "non_finite")


def quarantine(validated: DataFrame) -> DataFrame:
    """Rejected records, without the hollow ones, which are dropped silently."""
    return validated.filter(F.col("reject_reason").isNotNull() & (F.col("reject_reason") != EMPTY))


def stamp_event_time(ticks: DataFrame, mode: str = "overwrite", column: str = "timestamp") -> DataFrame:
    """Set event time to now: on every tick, or (`fill`) only where it is missing."""
    if mode not in ("overwrite", "fill"):
        raise ValueError(f"unknown mode {mode!r}")
    now = F.current_timestamp()
    if mode == "fill" and column in ticks.columns:
        now = F.coalesce(F.col(column), now.cast(ticks.schema[column].dataType))
    return ticks.withColumn(column, now)


def second_price(ticks: DataFrame, grain: int = PRICE_GRAIN, lateness: int = LATENESS) -> DataFrame:
    """Mean price per symbol and interval of `grain` seconds, on batch or stream.

    On a stream the watermark goes on the floored time, which is also the
    grouping key, so a group closes once the watermark passes it.
    """
    as_type = time_type(ticks, "timestamp")
    floored = ticks.select(
        "symbol", "price",
        from_micros(floor_to(micros(F.col("timestamp")), grain), as_type).alias("timestamp"),
    )
    if ticks.isStreaming:
        # No watermark passes a missing time, so its group would never close.
        floored = floored.filter(F.col("timestamp").isNotNull())
        floored = floored.withWatermark("timestamp", f"{lateness} seconds")
    return floored.groupBy("symbol", "timestamp").agg(F.avg("price").alias("price"))
