"""Joins that explode on purpose, under keys of any heat.

One user of the original data makes 913,138 of the join's 952,557 rows.  Where
such a join's rows are wanted, and not only their number (``joins.fanout``),
its output must be dealt out: the rows of a key form a grid of left slices times
right slices, and each cell is a join of its own.

Keys that need a grid are found by counting both sides; there are at most as
many as ``target_rows`` goes into the join's output and inputs, and their list
alone is broadcast, if it is small.  Cold keys are joined as ever.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.joins import broadcast_if_small
from quarry.session import kept


def hot_grids(left: DataFrame, right: DataFrame, left_key: str, right_key: str, target_rows: int) -> DataFrame:
    """key, n_left, n_right, rows_of, columns_of: the grid of every key whose left
    rows, right rows or pairs pass ``target_rows``.

    Slices of either side are so many that none has over ``target_rows`` rows and
    no cell many more pairs; the side with more rows is sliced first, since
    every slice of one side is met by a copy of the other."""
    lc = left.where(F.col(left_key).isNotNull()).groupBy(F.col(left_key).alias("key")).agg(F.count(F.lit(1)).alias("n_left"))
    rc = right.groupBy(F.col(right_key).alias("right_key")).agg(F.count(F.lit(1)).alias("n_right"))
    both = lc.join(rc, F.col("key") == F.col("right_key"), "left").select(
        "key", "n_left", F.coalesce("n_right", F.lit(0)).alias("n_right"))
    pairs = F.col("n_left").cast("double") * F.greatest("n_right", F.lit(1))
    cells = F.ceil(pairs / target_rows)
    hot = both.where((cells > 1) | (F.col("n_right") > target_rows))
    # As square a grid as the sides allow copies the fewest rows.
    along = F.sqrt(cells * F.col("n_left") / F.greatest("n_right", F.lit(1)))
    rows_of = F.least(F.col("n_left"), F.greatest(F.ceil(along), F.ceil(F.col("n_left") / target_rows), F.lit(1)))
    hot = hot.withColumn("rows_of", rows_of.cast("long"))
    columns_of = F.when(F.col("n_right") == 0, 1).otherwise(
        F.least("n_right", F.greatest(F.ceil(cells / F.col("rows_of")), F.ceil(F.col("n_right") / target_rows), F.lit(1))))
    return hot.withColumn("columns_of", columns_of.cast("long"))


def _dealt(df: DataFrame, key: str, grids: DataFrame, own: str, other: str, own_as: str, other_as: str) -> DataFrame:
    """Rows with their place in their key's grid: one slice of their own side, all of the other."""
    small = broadcast_if_small(grids.select(F.col("key").alias("_key"), F.col(own).alias("_own"),
                                            F.col(other).alias("_other")))
    # A row's slice: by its place in its partition, so that equal rows are dealt apart
    # as well, and those without a key, which match nothing, over all partitions.
    slice_: Column = F.when(F.col(key).isNull(), F.col("_turn")).otherwise(
        F.pmod("_turn", F.coalesce("_own", F.lit(1))))
    return (df.withColumn("_turn", F.monotonically_increasing_id())
            .join(small, F.col(key) == F.col("_key"), "left").withColumn(own_as, slice_)
            .withColumn(other_as, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_other", F.lit(1)) - 1)))
            .drop("_key", "_own", "_other", "_turn"))


def exploded_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner",
                  target_rows: int = 1_000_000) -> DataFrame:
    """All rows of the inner or left join of two sides on one key, hot keys in grids.

    ``left`` should be a scan (its rows' places in their partitions decide their
    slices, and a lost task must see them again in the same order)."""
    if how not in ("inner", "left"):
        raise ValueError("inner or left")
    grids = kept(hot_grids(left, right, left_key, right_key, target_rows), "hot-keys")
    columns = [*left.columns, *right.columns]

    def joined(left_rows: DataFrame, which: DataFrame, kind: str) -> DataFrame:
        a = _dealt(left_rows, left_key, which, "rows_of", "columns_of", "_i", "_j")
        b = _dealt(right, right_key, which, "columns_of", "rows_of", "_j2", "_i2")
        cell = (F.col(left_key) == F.col(right_key)) & (F.col("_i") == F.col("_i2")) & (F.col("_j") == F.col("_j2"))
        return a.join(b, cell, kind).select(*columns)

    if how == "inner":
        return joined(left, grids, "inner")
    # A left row of a hot key meets its matches in several cells: these keys have
    # matches, so an inner join has all their rows.  All others are in one column.
    matched = grids.where("n_right > 0")
    keys = broadcast_if_small(matched.select(F.col("key").alias("_hot")))
    of_hot = F.col(left_key) == F.col("_hot")
    hot = joined(left.join(keys, of_hot, "left_semi"), matched, "inner")
    rest = joined(left.join(keys, of_hot, "left_anti"), grids.where("n_right = 0"), "left")
    return hot.unionByName(rest)
