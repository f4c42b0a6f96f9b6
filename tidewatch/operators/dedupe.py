"""Watermarking and removal of repeated events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import WindowConfig


def with_delay(events: DataFrame, delay: str | None) -> DataFrame:
    """Sets the event-time watermark on a stream; a table is returned as it is."""
    if delay and events.isStreaming:
        return events.withWatermark("event_ts", delay)
    return events


def deduplicate(
    events: DataFrame,
    key: str = "event_id",
    delay: str | None = WindowConfig.watermark,
    spread: int = 1,
) -> DataFrame:
    """One row per event id.

    On a table the earliest copy wins, ties going to the smallest remaining columns. The
    minimum is taken before the shuffle as well, so an id with very many copies sends one
    row per task.

    On a stream the watermark bounds the state: a copy is recognised for ``delay`` after the
    first. ``spread`` > 1 first removes copies within that many random buckets, so a burst of
    copies of one id is worked off by several tasks instead of one. The seed is fixed: a task
    that runs again after a lost executor sorts its rows into the same buckets.
    """
    if not events.isStreaming:
        return _earliest(events, key)
    stream = with_delay(events, delay)
    if spread > 1:
        bucketed = stream.withColumn("_bucket", F.floor(F.rand(0) * spread).cast("int"))
        stream = bucketed.dropDuplicatesWithinWatermark([key, "_bucket"]).drop("_bucket")
    return stream.dropDuplicatesWithinWatermark([key])


def _earliest(events: DataFrame, key: str) -> DataFrame:
    # Null sorts before any value in a struct comparison, so a copy without time comes last
    # by a leading flag.
    others = [name for name in events.columns if name not in (key, "event_ts")]
    packed = F.struct(F.col("event_ts").isNull().alias("undated"), "event_ts", *others)
    first = events.groupBy(key).agg(F.min(packed).alias("first"))
    return first.select(*(F.col(key) if name == key else F.col(f"first.{name}") for name in events.columns))
