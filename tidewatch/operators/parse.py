"""Wire rows to typed events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.schema import EVENT_SCHEMA, EVENTS_SCHEMA, LANDED_SCHEMA


def decode_events(raw: DataFrame) -> DataFrame:
    """All wire rows as typed fields plus ``event_ts`` and ``event_date``, malformed ones as nulls.

    ``inline`` keeps the JSON decoder below the filters that follow. As a plain expression it
    would be copied into every pushed-down predicate and run several times per row.
    """
    decoded = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA)
    return (
        raw.select(F.inline(F.array(decoded)))
        .withColumn("event_ts", F.try_to_timestamp("timestamp"))
        .withColumn("event_date", F.to_date("event_ts"))
    )


def _usable():
    return F.col("event_id").isNotNull() & F.col("user_id").isNotNull()


def parse_events(raw: DataFrame) -> DataFrame:
    """Typed events that carry both an event id and a user id."""
    return decode_events(raw).filter(_usable())


def split_valid(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) events; a stream can send the rejects to a table of their own."""
    decoded = decode_events(raw)
    return decoded.filter(_usable()), decoded.filter(~_usable())


# What a landed row is.
EVENT, MISDATED, REJECT = "event", "misdated", "reject"


def landing(raw: DataFrame, skew: str) -> DataFrame:
    """Every wire row as it is landed, decoded once: no state, no watermark, nothing dropped.

    ``kind`` is ``event`` for a usable event, ``misdated`` for one whose time lies further ahead of the landing clock than
    ``skew``, and ``reject`` for a row that gives no usable event; that one keeps its text in ``value`` and has the date it was landed.
    """
    decoded = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA)
    rows = raw.select(F.col("value").cast("string").alias("value"), F.inline(F.array(decoded))).select(
        "*", F.try_to_timestamp("timestamp").alias("event_ts"), F.current_timestamp().alias("landed_at")
    )
    ahead = F.coalesce(F.col("event_ts") > F.col("landed_at") + F.expr(f"INTERVAL {skew}"), F.lit(False))
    kind = F.when(~_usable(), REJECT).when(ahead, MISDATED).otherwise(EVENT)
    dated = F.when(F.col("kind") == REJECT, F.to_date("landed_at")).otherwise(F.to_date("event_ts"))
    return rows.withColumn("kind", kind).select(
        *(F.when(F.col("kind") == REJECT, F.col("value")).alias("value") if name == "value" else name for name in LANDED_SCHEMA.fieldNames()[:-1]),
        dated.alias("event_date"),
    )


def landed_rows(landed: DataFrame, *kinds: str) -> DataFrame:
    """Landed rows of some kinds: events without the columns that only rejected rows need, or those rows."""
    rows = landed.filter(F.col("kind").isin(*kinds))
    if REJECT in kinds:
        return rows.select("value", "event_id", "user_id", "landed_at", "event_date")
    return rows.select(*EVENTS_SCHEMA.fieldNames())


def reject_counts(raw: DataFrame) -> DataFrame:
    """One row: how many wire rows were usable, rejected, and usable without a time."""
    return decode_events(raw).agg(
        F.count_if(_usable()).alias("valid"),
        F.count_if(~_usable()).alias("rejected"),
        F.count_if(_usable() & F.col("event_ts").isNull()).alias("without_time"),
    )
