"""Sorting, paging, top-k and best-in-group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """ORDER BY … LIMIT k / TOP k (O6): planned as a distributed take-ordered.

    Callers put a unique tie-break last in ``order`` so the result is stable.
    """
    return df.orderBy(*order).limit(k)


def page(df: DataFrame, order: Sequence[Column], offset: int, n: int) -> DataFrame:
    """``LIMIT n OFFSET m`` (O5), 0-based offset, over a total order."""
    return df.orderBy(*order).offset(offset).limit(n)


def best_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                  keep: int = 1, method: str = "rank", rank_col: str = "rnk") -> DataFrame:
    """Rows ranked ``<= keep`` within each group (W1, W2 = QUALIFY rank <= k).

    ``rank`` keeps ties (RANK), ``row_number`` one per group.
    Spark turns the rank filter into a per-partition WindowGroupLimit before
    the shuffle, so only candidate rows travel.
    """
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, fn().over(w)).filter(F.col(rank_col) <= keep)


def count_best(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column],
               count_name: str = "n_groups") -> DataFrame:
    """How many groups have their best row in each bucket."""
    best = best_in_group(df, group, order, keep=1, method="rank")
    return best.groupBy(bucket).agg(F.count(F.lit(1)).alias(count_name))
