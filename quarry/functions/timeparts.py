"""Date parts, durations and shifts.

SQL dialect names → Spark built-ins:
  YEAR/MONTH/DAY, EXTRACT   → year / month / dayofmonth / extract
  DAYNAME (full name)       → date_format(ts, 'EEEE')   (Spark's dayname gives 'Tue')
  DAYOFWEEK (1 = Sunday)    → dayofweek                  (same numbering)
  TIMESTAMPDIFF(unit, a, b) → timestamp_diff             (whole units, toward zero)
  DATE_SUB(ts, INTERVAL h HOUR) → ts - interval          (keeps the time of day)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ts_literal(text: str) -> Column:
    """A ``timestamp_ntz`` literal from 'yyyy-mm-dd[ hh:mm:ss]' (F8)."""
    return F.lit(text).cast("timestamp_ntz")


def whole_units_between(unit: str, start, end) -> Column:
    """Whole ``unit``s from ``start`` to ``end``, truncated toward zero.

    119 s is 1 minute, -119 s is -1 minute; negative when end precedes start.
    """
    return F.timestamp_diff(unit.upper(), _c(start), _c(end))


def weekday_name(ts) -> Column:
    """Full English weekday name, 'Monday' … 'Sunday' (X7)."""
    return F.date_format(_c(ts), "EEEE")


def weekday_number(ts) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(_c(ts))


def shift_hours(ts, hours: int) -> Column:
    """Move a timestamp by whole hours, keeping the time of day."""
    return _c(ts) + F.make_dt_interval(hours=F.lit(hours))


def day_bit(ts) -> Column:
    """The day of the month as one bit of a long: 1 << (day - 1).

    ``bit_or`` of these over a (key, year, month) group is a bitmap of the
    sale days, and ``bit_count`` of the bitmap is the exact number of distinct
    days - an algebraic aggregate with one 64-bit word of state per group.
    """
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(_c(ts)) - 1)


def month_abbrev(month) -> Column:
    """Month number 1-12 → 'Jan' … 'Dec' (X17); NULL outside the range."""
    m = _c(month)
    return F.when(m.between(1, 12), F.date_format(F.make_date(F.lit(2000), m, F.lit(1)), "MMM"))
