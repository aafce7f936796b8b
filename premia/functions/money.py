"""Money and penalty expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"

# Fixed values of the penalty rule: 30 days count as a month, half a percent is due per month.
DAYS_PER_MONTH = 30
RATE_PER_MONTH = Decimal("0.005")


def parse_money(c: Column, sql_type: str = MONEY) -> Column:
    """Drop ``$`` and thousands commas; text that is no number becomes null."""
    return F.regexp_replace(c.cast("string"), "[$,]", "").try_cast(sql_type)


def late_months(days: Column) -> Column:
    """Whole months of delay, ties to the even month; no dates count as no delay, early payers are negative."""
    return F.coalesce(F.bround(days / F.lit(DAYS_PER_MONTH)).cast("int"), F.lit(0))


def late_fee_rate(months: Column) -> Column:
    """Share of the premium due for a delay; nothing for early or punctual payers, no upper limit."""
    return F.greatest(months, F.lit(0)) * F.lit(RATE_PER_MONTH)
