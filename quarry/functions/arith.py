"""Safe arithmetic for ratios and period comparisons.

Division goes through ``try_divide``: a zero or NULL denominator gives NULL
(the original dialect's behaviour) instead of an ANSI error that would kill the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ratio(num, den) -> Column:
    return F.try_divide(_c(num), _c(den))


def pct_change(new, old) -> Column:
    """(new - old) / old * 100, NULL when ``old`` is 0 or NULL."""
    return F.try_divide(_c(new) - _c(old), _c(old)) * F.lit(100.0)
