"""Which months of a fact are whole (D9): found in the data, not stated.

The last month of a running table has only its first days; its totals and its
rates per day mislead.  A month counts as whole if at least ``LEAST_SHARE`` of
its calendar days have a row.  The check is a job of its own: it reads one column and
reduces it to a bitmap of days per month map-side.  Its result, at most twelve
rows for each calendar year, becomes ranges of the time column that a report's
scan leaves out by its statistics.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.predicates import drop_period
from quarry.functions.timeparts import day_bit

LEAST_SHARE = 0.5


def month_coverage(fact: DataFrame, ts: str) -> DataFrame:
    """month (its first day), n_days with a row, days_in_month, share."""
    month = F.trunc(ts, "month").alias("month")
    days = fact.where(F.col(ts).isNotNull()).groupBy(month).agg(
        F.bit_count(F.bit_or(day_bit(ts))).cast("long").alias("n_days"))
    return days.withColumn("days_in_month", F.dayofmonth(F.last_day("month")).cast("long")).withColumn(
        "share", F.col("n_days") / F.col("days_in_month"))


def incomplete_months(fact: DataFrame, ts: str, least_share: float = LEAST_SHARE) -> list[date]:
    """First days of the months with rows on too few days."""
    short = month_coverage(fact, ts).where(F.col("share") < least_share).select("month")
    return sorted(r["month"] for r in short.collect())  # at most twelve a year


def in_whole_months(rows: DataFrame, fact: DataFrame, ts: str, least_share: float = LEAST_SHARE) -> DataFrame:
    """The rows with a time whose month is a whole one of ``fact``."""
    out = rows.where(F.col(ts).isNotNull())
    for m in incomplete_months(fact, ts, least_share):
        out = out.where(drop_period(ts, m.year, m.month))
    return out
