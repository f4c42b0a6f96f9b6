"""Conditional counts and exact money arithmetic.

Amounts are summed in ten-thousandths, as decimals, and rounded once at the end, so a result does
not depend on how Spark happened to split or merge the rows, and many small amounts add up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_of(event_type: str) -> Column:
    """Rows of one event type."""
    return F.count_if(F.col("event_type") == event_type)


def count_name(event_type: str) -> str:
    """Column name of a per-type count: ``page_view`` gives ``count_pageview``."""
    return "count_" + event_type.replace("_", "")


# Amounts beyond this, infinite ones and NaN are no amounts.
MOST = 1e12
# Parts of one unit that amounts are summed in.
PARTS = 10_000


def finite(amount: Column | str) -> Column:
    """The amount, or null where it is not a number that can be summed."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    # NaN is larger than any number in Spark's order.
    return F.when((amount <= MOST) & (amount >= -MOST), amount)


def cents(amount: Column | str) -> Column:
    """An amount in whole cents."""
    return F.round(finite(amount) * 100).cast("long")


def parts(amount: Column | str) -> Column:
    """An amount in ten-thousandths."""
    return F.round(finite(amount) * PARTS).cast("long")


def sum_of_parts(amount: Column | str) -> Column:
    """Sum in ten-thousandths; a decimal, so no number of rows overflows it."""
    return F.sum(parts(amount).cast("decimal(20,0)"))


def whole_cents(total: Column | str) -> Column:
    """A sum of parts in whole cents, rounded half away from zero; null if too large for a long."""
    total = F.col(total) if isinstance(total, str) else total
    return F.round(total / F.lit(PARTS // 100).cast("decimal(3,0)"), 0).try_cast("long")


def money(amount_in_cents: Column | str) -> Column:
    """Whole cents back to an amount with two decimals."""
    value = F.col(amount_in_cents) if isinstance(amount_in_cents, str) else amount_in_cents
    return value / F.lit(100.0)


def revenue_parts() -> Column:
    """Sum of the amounts of all rows in parts; rows without amount add nothing."""
    return F.coalesce(sum_of_parts("amount"), F.lit(0).cast("decimal(20,0)"))


def floor_div(value: Column, step: int) -> Column:
    """Whole-number division rounding down, also below zero."""
    return F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step))


def quotient_sql(numerator: str, denominator: str) -> str:
    """SQL of ``numerator / denominator`` rounded half away from zero to a whole number, exactly.

    Both are whole-number SQL expressions and the denominator is not negative; a zero
    denominator gives null.
    """
    whole = f"((abs({numerator}) * 2 + {denominator}) div nullif({denominator} * 2, 0L))"
    return f"(CASE WHEN {numerator} < 0 THEN -{whole} ELSE {whole} END)"


def ratio_sql(numerator: str, denominator: str, digits: int) -> str:
    """SQL of ``numerator / denominator`` rounded half away from zero to ``digits`` decimals."""
    scale = 10**digits
    return f"({quotient_sql(f'({numerator} * {scale})', denominator)} / {float(scale)}D)"


def round_double_sql(value: str, digits: int) -> str:
    """SQL of a double rounded half away from zero to ``digits`` decimals."""
    scale = f"{float(10**digits)}D"
    return f"(signum({value}) * floor(abs({value}) * {scale} + 0.5D) / {scale})"


def mean_money(total_parts: str, count: str) -> Column:
    """Mean amount with two decimals from a sum of parts; null when there is nothing to average."""
    return money(F.expr(quotient_sql(total_parts, f"({count} * {PARTS // 100}L)")))
