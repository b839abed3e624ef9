"""Date and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(ts: Column | str) -> Column:
    """yyyyMMdd as INT, the calendar's key."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyyMMdd").cast("int")


def padded_name(d: Column, pattern: str, pad: bool = True) -> Column:
    """Full day or month name; blank-padded to 9 characters like a fixed-width
    'Day' / 'Month' text format, or trimmed when ``pad`` is False."""
    name = F.date_format(d, pattern)
    return F.rpad(name, 9, " ") if pad else name


def month_start(d: Column | str) -> Column:
    """First day of the month, kept as DATE."""
    return F.trunc(F.col(d) if isinstance(d, str) else d, "MM")


def whole_months_between(later: Column, earlier: Column) -> Column:
    """Whole months between two month starts (negative when ``later`` is
    earlier); exact because both sides are first days of a month."""
    return F.months_between(later, earlier).cast("bigint")
