"""Labels, range bins, value maps and text cleaning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


@dataclass(frozen=True)
class Bin:
    """One class of a range binning.  ``None`` bounds are open."""

    label: str
    lo: float | None = None
    hi: float | None = None
    lo_closed: bool = True
    hi_closed: bool = True

    def test(self, c: Column) -> Column:
        cond = F.lit(True)
        if self.lo is not None:
            cond = cond & (c >= self.lo if self.lo_closed else c > self.lo)
        if self.hi is not None:
            cond = cond & (c <= self.hi if self.hi_closed else c < self.hi)
        return cond


def bin_by(col, bins: list[Bin], else_label: str | None = None) -> Column:
    """Searched-CASE range binning (X16): first matching bin wins, else ``else_label``.

    NULL input matches no bin and gets ``else_label``, as CASE ... ELSE does.
    """
    c = _c(col)
    out = None
    for b in bins:
        out = F.when(b.test(c), F.lit(b.label)) if out is None else out.when(b.test(c), F.lit(b.label))
    return out.otherwise(F.lit(else_label)) if else_label is not None else out


def map_values(col, mapping: dict, else_value=None) -> Column:
    """Simple ``CASE x WHEN v THEN … END`` (X15); unmatched → ``else_value``."""
    c = _c(col)
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(else_value)) if else_value is not None else out


def two_way(cond: Column, then_value, else_value) -> Column:
    """``IF(cond, a, b)`` (X13): a NULL condition takes the else branch."""
    return F.when(cond, then_value).otherwise(else_value)


def clean_label(col, strip_leading: str | None = None, replace: tuple[str, str] | None = None,
                upper: bool = False) -> Column:
    """Label cleaning chain (X1-X3, D8): replace text, strip leading chars, upper-case."""
    c = _c(col)
    if replace is not None:
        c = F.replace(c, F.lit(replace[0]), F.lit(replace[1]))
    if strip_leading is not None:
        c = F.ltrim(c, F.lit(strip_leading))
    if upper:
        c = F.upper(c)
    return c


def order_by_list(col, values: list) -> Column:
    """Position of ``col`` in a fixed list, 1-based, 0 when absent (O7, like FIELD)."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), _c(col))


# Calendar order of weekday names used by O7 reports.
WEEKDAYS_MONDAY_FIRST = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
