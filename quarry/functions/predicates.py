"""Row predicates with the original queries' NULL, blank and letter-case rules.

All return Columns built from built-in expressions, so they stay inside
whole-stage codegen.  Date predicates are written as ranges on the raw column
(not ``year(ts) = y``) so Parquet can skip row groups on min/max statistics.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.timeparts import ts_literal


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ci_eq(col, value: str) -> Column:
    """Case-insensitive equality (F10): compare under the UTF8_LCASE collation."""
    return F.collate(_c(col), "UTF8_LCASE") == F.lit(value)


def ci_like(col, pattern: str) -> Column:
    """Case-insensitive LIKE with ``%``/``_`` wildcards."""
    return _c(col).ilike(pattern)


def not_flagged(col, flag=1) -> Column:
    """Keep rows whose flag is NULL or anything but ``flag``.

    ``col != 1`` would silently drop the NULL rows; null-safe equality keeps them.
    """
    return ~_c(col).eqNullSafe(F.lit(flag))


def not_blank(col) -> Column:
    """Neither NULL nor the empty string (F7): the two are different values."""
    c = _c(col)
    return c.isNotNull() & (c != F.lit(""))


def _month_start(year: int, month: int) -> _dt.date:
    return _dt.date(year + (month - 1) // 12, (month - 1) % 12 + 1, 1)


def in_period(ts, year: int, month: int | None = None) -> Column:
    """``ts`` falls in the given year (or year-month), as a prunable range."""
    c = _c(ts)
    if month is None:
        lo, hi = _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1)
    else:
        lo, hi = _month_start(year, month), _month_start(year, month + 1)
    return (c >= ts_literal(lo.isoformat())) & (c < ts_literal(hi.isoformat()))


def drop_period(ts, year: int, month: int | None = None) -> Column:
    """``NOT (year = y AND month = m)`` (F12, D9) as a pushable pair of ranges.

    NULL timestamps are dropped, as the three-valued original does.
    """
    c = _c(ts)
    if month is None:
        lo, hi = _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1)
    else:
        lo, hi = _month_start(year, month), _month_start(year, month + 1)
    return (c < ts_literal(lo.isoformat())) | (c >= ts_literal(hi.isoformat()))


def after(ts, date_text: str) -> Column:
    """``ts > 'yyyy-mm-dd'`` with the literal typed as a timestamp (F8)."""
    return _c(ts) > ts_literal(date_text)


def before(ts, date_text: str) -> Column:
    return _c(ts) < ts_literal(date_text)
