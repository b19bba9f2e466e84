"""The guarded product (J8): every combination of two small sides, as a spine for reports.

A product is only wanted where a report must show combinations without rows:
each region in each calendar month.  ``product`` forms one under two stated
bounds, checked before anything is multiplied, and raises beyond them; the
short side travels inside the plan, so no join operator, shuffle or broadcast
takes part.  ``fill`` brings a fact's aggregates onto the spine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RIGHT = 1_000        # rows of the side that is held in the plan
MAX_PRODUCT = 1_000_000  # rows of a product


class ProductTooLarge(ValueError):
    """A product would pass its stated row bound."""


def product(left: DataFrame, right: DataFrame, max_rows: int = MAX_PRODUCT, max_right: int = MAX_RIGHT) -> DataFrame:
    """All combinations of the rows of two sides with different column names.

    Raises :class:`ProductTooLarge` if ``right`` has over ``max_right`` rows or
    the product over ``max_rows``; neither side is counted past its bound."""
    if set(left.columns) & set(right.columns):
        raise ValueError("both sides have a column of one name")
    rows = right.limit(max_right + 1).collect()  # at most max_right + 1 rows
    if len(rows) > max_right:
        raise ProductTooLarge(f"the right side has over {max_right} rows")
    if not rows:
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema]
        return left.select("*", *empty).limit(0)
    most_left = max_rows // len(rows)
    if left.limit(most_left + 1).count() > most_left:
        raise ProductTooLarge(f"the left side has over {most_left} rows for {len(rows)} on the right")
    kind = right.schema
    each = [F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in kind]) for r in rows]
    return left.select("*", F.explode(F.array(*each)).alias("_right")).select(*left.columns, "_right.*")


def month_spine(left: DataFrame, fact: DataFrame, ts: str, max_rows: int = MAX_PRODUCT,
                month: str = "month") -> DataFrame:
    """``left`` times every calendar month from the fact's first to its last,
    also those in which the fact has no row."""
    ends = fact.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
    months = ends.select(F.explode(F.sequence(F.trunc("first", "month"), F.trunc("last", "month"),
                                              F.expr("interval 1 month"))).alias(month))
    return product(left, months, max_rows)


def fill(spine: DataFrame, counts: DataFrame, on: Sequence[str], zero: Sequence[str | Column]) -> DataFrame:
    """The spine with a fact's aggregates (one row a combination), 0 where it has none."""
    joined = spine.join(counts, list(on), "left")
    return joined.fillna(0, subset=list(zero))
