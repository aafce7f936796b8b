"""Date expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

#: Tried in this order.
FEED_DATE_FORMATS = ("M/d/yyyy", "yyyy-MM-dd", "M/d/yyyy H:mm", "yyyy-MM-dd HH:mm:ss", "M/d/yy")
# The two ways to order day and month, and formats that leave no doubt.
PLAIN_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")
DATE_ORDERS = {
    "month first": ("M/d/yyyy", "M/d/yyyy H:mm", "M/d/yy", *PLAIN_FORMATS),
    "day first": ("d/M/yyyy", "d/M/yyyy H:mm", "d/M/yy", *PLAIN_FORMATS),
}
OPEN_END = dt.date(9999, 12, 31)
EARLIEST_START = dt.date(1900, 1, 1)


def parse_date(c: Column, formats: str | Sequence[str] = FEED_DATE_FORMATS) -> Column:
    """Parse a date by the first format that fits; text that fits none becomes null."""
    tried = [formats] if isinstance(formats, str) else formats
    return F.coalesce(*[F.try_to_date(c, f) for f in tried])


def date_key(c: Column) -> Column:
    """The ``yyyymmdd`` integer of a date, 0 for no date."""
    return F.coalesce(F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c), F.lit(0))


def date_of_key(c: Column) -> Column:
    """The date of a ``yyyymmdd`` integer; null where it names no day."""
    return F.try_to_date(c.cast("string"), "yyyyMMdd")


def in_year(c: Column, year: int) -> Column:
    """True within a calendar year, as a range the file scan can push down."""
    return (c >= F.lit(dt.date(year, 1, 1))) & (c < F.lit(dt.date(year + 1, 1, 1)))
