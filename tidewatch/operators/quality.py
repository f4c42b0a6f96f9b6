"""Checks of the event contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import DEVICES, EVENT_TYPES
from tidewatch.functions.measures import finite
from tidewatch.schema import EVENT_FIELDS

REQUIRED = tuple(name for name in EVENT_FIELDS if name != "amount")


def check_contract(
    events: DataFrame,
    types: tuple[str, ...] = EVENT_TYPES,
    devices: tuple[str, ...] = DEVICES,
) -> DataFrame:
    """A long table ``rule, violations``, every rule present, zero when it holds.

    A row's broken rules are the bits of one number, so what a task sends on is a row for each combination that it met, and
    the rules are counted from those few. How often an id occurs takes a count by id alone, which reads no other column.
    """
    buys = F.col("event_type") == "purchase"
    rules = {
        **{f"{name}_present": F.col(name).isNull() for name in REQUIRED},
        "event_type_known": ~F.col("event_type").isin(*types),
        "device_known": ~F.col("device").isin(*devices),
        "amount_is_finite": F.col("amount").isNotNull() & finite("amount").isNull(),
        "purchase_has_amount": buys & (F.col("amount").isNull() | (F.col("amount") <= 0)),
        "other_has_no_amount": ~buys & F.col("amount").isNotNull(),
        "timestamp_is_iso": ~(F.col("timestamp").contains("T") & F.col("timestamp").rlike(r"Z$|\+")),
        "timestamp_readable": F.col("timestamp").isNotNull() & F.col("event_ts").isNull(),
    }
    tests = {**rules, "_views": F.col("event_type") == "page_view", "_buys": buys}
    bits = [F.when(test, F.lit(1 << place)).otherwise(F.lit(0)) for place, test in enumerate(tests.values())]
    combinations = events.groupBy(reduce(Column.bitwiseOR, bits).alias("broken")).agg(F.count(F.lit(1)).alias("rows"))

    zero = F.lit(0).cast("long")
    counted = {
        name: F.coalesce(F.sum(F.when(F.col("broken").bitwiseAND(1 << place) != 0, F.col("rows"))), zero)
        for place, name in enumerate(tests)
    }
    totals = combinations.agg(*(total.alias(name) for name, total in counted.items()))
    # One violation for the whole table when views do not clearly outnumber purchases.
    crowded = (F.col("_views") <= 3 * F.col("_buys")).cast("long")
    totals = totals.withColumn("views_outnumber_purchases", crowded)
    names = (*rules, "views_outnumber_purchases")
    by_rule = totals.select(
        F.inline(F.array(*(F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("violations")) for rule in names)))
    )
    copies = events.filter(F.col("event_id").isNotNull()).groupBy("event_id").agg(F.count(F.lit(1)).alias("copies"))
    repeated = copies.agg(F.coalesce(F.sum(F.col("copies") - 1), zero).alias("violations"))
    return by_rule.unionByName(repeated.select(F.lit("event_id_unique").alias("rule"), "violations"))
