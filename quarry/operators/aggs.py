"""Aggregation building blocks.

Distinct-day counting at fact scale (A15, A16, D10) never uses
``COUNT(DISTINCT day)``: that plans an extra shuffle keyed by (group, day)
and, with several of them, an Expand that copies every fact row once per
distinct expression.  Instead the fact is reduced to one row per
(entity, year, month) holding the amount sums and a 31-bit bitmap of its
sale days (``bit_or``); the distinct-day count is ``bit_count`` of that
bitmap.  All of it is algebraic, so map-side partial aggregation collapses a
hot entity before the shuffle, and the per-group state is one word.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.arith import ratio
from quarry.functions.timeparts import day_bit


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def attr(col) -> Column:
    """The group's value when it is constant (NULLs included in the check), else NULL."""
    c = _c(col)
    constant = (F.min(c).eqNullSafe(F.max(c))) & (F.count(c) == F.count(F.lit(1)))
    return F.when(constant, F.min(c))


def representative(value, *order) -> Column:
    """A deterministic stand-in for a loose GROUP BY column.

    The value on the row with the smallest ``order`` tuple; ties in the tuple
    are broken by the value itself, so reruns (and recomputed tasks) agree.
    """
    v = _c(value)
    return F.min(F.struct(*[_c(o) for o in order], v.alias("_v")))["_v"]


def spread(col, prefix: str, median_exact: bool = False) -> list[Column]:
    """Mean, population/sample standard deviation, median and coefficient of variation.

    The median is by default the sketch-based ``percentile_approx``: fixed
    memory per group however large or skewed the group.  ``median_exact=True``
    uses Spark's exact percentile, whose per-group state is a value→count map -
    only bounded when the column has a bounded domain (whole quantities,
    ratings 0-9), which the caller must know.
    """
    c = _c(col)
    med = F.median(c) if median_exact else F.percentile_approx(c, 0.5, 10000)
    return [
        F.avg(c).alias(f"{prefix}_avg"),
        F.stddev_pop(c).alias(f"{prefix}_std_pop"),
        F.stddev_samp(c).alias(f"{prefix}_std_samp"),
        med.alias(f"{prefix}_median"),
        ratio(F.stddev_pop(c), F.avg(c)).alias(f"{prefix}_cv"),
    ]


def pivot_sums(value, period, periods: Mapping[str, object]) -> list[Column]:
    """``SUM(CASE WHEN period = v THEN value END) AS label`` per period.

    A period with no rows stays NULL, as the CASE without ELSE does.
    """
    return [F.sum(F.when(_c(period) == F.lit(v), _c(value))).alias(label)
            for label, v in periods.items()]


def per_month(df: DataFrame, keys: Sequence[str], ts, sums: Mapping[str, object]) -> DataFrame:
    """Reduce a fact to one row per (keys, year, month): the given sums plus
    ``day_mask``, the bitmap of days with at least one row (stage 1 of A15/A16)."""
    c = _c(ts)
    return df.groupBy(*keys, F.year(c).alias("year"), F.month(c).alias("month")).agg(
        *[F.sum(_c(v)).alias(name) for name, v in sums.items()],
        F.bit_or(day_bit(c)).alias("day_mask"))


def days_in(mask="day_mask") -> Column:
    """Number of distinct days in a day bitmap; 0 for a group without any date."""
    return F.coalesce(F.bit_count(_c(mask)).cast("long"), F.lit(0).cast("long"))


def daily_rate(monthly: DataFrame, keys: Sequence[str], amount: str = "amount",
               min_days: int | None = None, unit_scale: int = 1) -> DataFrame:
    """Average daily amount = SUM(amount) / number of distinct days.

    ``monthly`` comes from :func:`per_month`; ``keys`` may include ``year`` /
    ``month`` or not.  The day count adds up the bitmaps' bit counts - exact,
    since a day belongs to exactly one (year, month).  Money may arrive as
    integer minor units (cents, ``unit_scale=100``): ``revenue`` is then an
    exact sum, independent of summation order, and only the rate is a double.
    """
    out = monthly.groupBy(*keys).agg(F.sum(days_in()).alias("num_days"),
                                     F.sum(amount).alias("revenue"))
    if min_days is not None:
        out = out.filter(F.col("num_days") >= min_days)
    return out.withColumn("daily_revenue", scaled_ratio("revenue", "num_days", unit_scale))


def scaled_ratio(amount, count, unit_scale: int = 1) -> Column:
    """(amount / unit_scale) / count as double, NULL for a zero count."""
    return ratio(_c(amount).cast("double") / F.lit(unit_scale), _c(count))


def period_daily_rates(monthly: DataFrame, keys: Sequence[str], period_col: str,
                       periods: Mapping[str, object], amount: str = "amount") -> DataFrame:
    """Per entity: amount and day count for each named period, side by side (A14 + A15).

    ``COUNT(DISTINCT CASE WHEN period = v THEN day END)`` becomes
    ``SUM(CASE WHEN period = v THEN bit_count(day_mask) END)`` over the
    per-month rows of :func:`per_month`.
    """
    aggs = []
    for label, v in periods.items():
        hit = F.col(period_col) == F.lit(v)
        aggs.append(F.sum(F.when(hit, F.col(amount))).alias(f"{label}_sales"))
        aggs.append(F.coalesce(F.sum(F.when(hit, days_in())), F.lit(0)).alias(f"{label}_days"))
    return monthly.groupBy(*keys).agg(*aggs)


def cents(col) -> Column:
    """A two-decimal money column as exact integer cents (sums stay exact)."""
    return F.round(_c(col) * F.lit(100)).cast("long")


def with_total(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Per-group rows plus the overall total in one pass (A23), via ROLLUP."""
    return df.rollup(*keys).agg(*aggs, F.grouping_id().alias("is_total"))
