"""Data-quality profiles (S3 re-aimed, D1, D4, D6, D12, D13).

``profile_table`` replaces ``DESCRIBE``/``SHOW COLUMNS`` with the numbers the
lessons compute by hand: per column, rows, NULLs, non-NULLs and distinct
values.  Exact distinct counts use one (column, value) aggregation over a
stacked view of the table - partial aggregation collapses repeated values on
the map side - rather than one COUNT(DISTINCT) per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _as_text(df: DataFrame, column: str):
    """A column's values as short text, one text per value.

    0.0 and -0.0 are one number.  A text of over 40 characters is represented
    by its 128-bit digest, so the shuffle never carries long values; two texts
    with one digest, which would count as one, are not expected in any table.
    """
    if df.schema[column].dataType.simpleString() in ("float", "double"):
        return (F.col(column) + F.lit(0.0)).cast("string")
    v = F.col(column).cast("string")
    return F.when(F.length(v) > 40, F.md5(v.cast("binary"))).otherwise(v)


def profile_table(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True,
                  with_types: bool = False) -> DataFrame:
    """One row per column: n_rows, n_nulls, n_non_null, n_distinct (NULL not counted).

    Each row is stacked into (column position, value as text); only the small
    integer position travels in the shuffle key, and the column's name (and,
    with ``with_types``, its type and nullability) is attached to the per-column
    result afterwards.
    """
    cols = list(columns or df.columns)
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), _as_text(df, c).alias("v"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")
    if exact:
        per_value = stacked.groupBy("pos", "v").agg(F.count(F.lit(1)).alias("n"))
        out = per_value.groupBy("pos").agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("n_nulls"),
            F.count("v").alias("n_distinct"))
    else:
        out = stacked.groupBy("pos").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("v").isNull()).alias("n_nulls"),
            F.approx_count_distinct("v", 0.01).alias("n_distinct"))

    def by_pos(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("pos") + 1)

    fields = {f.name: f for f in df.schema.fields}
    extra = []
    if with_types:
        extra = [by_pos([fields[c].dataType.simpleString() for c in cols]).alias("data_type"),
                 by_pos([fields[c].nullable for c in cols]).alias("nullable")]
    return out.select(by_pos(cols).alias("column_name"), *extra,
                      F.col("n_rows"), F.col("n_nulls"),
                      (F.col("n_rows") - F.col("n_nulls")).alias("n_non_null"),
                      F.col("n_distinct").cast("long").alias("n_distinct"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "n_rows") -> DataFrame:
    """Keys occurring more than once (D4), with their row counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
            .filter(F.col(count_name) > 1))


def orphan_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Keys present on one side only, both directions, with row counts.

    Each side is first reduced to (key, rows), so a key holding a third of the
    data is one row; one full outer join of the two per-key counts (both
    already partitioned by key) then finds the orphans of both sides.  A NULL
    key never matches, so it is reported on its own side, as NOT EXISTS would.
    """
    lk = left.groupBy(F.col(left_key).alias("key")).agg(F.count(F.lit(1)).alias("n_left"))
    rk = right.groupBy(F.col(right_key).alias("rkey")).agg(F.count(F.lit(1)).alias("n_right"))
    j = lk.join(rk, F.col("key") == F.col("rkey"), "full")
    only_left = F.col("n_right").isNull()
    return (j.filter(only_left | F.col("n_left").isNull())
            .select(F.when(only_left, F.lit(left_name)).otherwise(F.lit(right_name)).alias("only_in"),
                    F.when(only_left, F.col("key")).otherwise(F.col("rkey")).alias("key"),
                    F.when(only_left, F.col("n_left")).otherwise(F.col("n_right")).alias("n_rows")))


def blank_null_breakdown(df: DataFrame, col: str, out: str = "kind") -> DataFrame:
    """Rows of one column by what they hold: nothing, blank text or a value."""
    length = F.length(col)
    holds = F.element_at(F.array(F.lit("nothing"), F.lit("blank"), F.lit("value")),
                         F.when(length > 0, 3).when(length == 0, 2).otherwise(1))
    return df.groupBy(holds.alias(out)).agg(F.count(F.lit(1)).alias("n_rows"))


def all_null_columns(df: DataFrame) -> DataFrame:
    """Columns holding no value at all (D13): a join on them matches nothing."""
    return profile_table(df).filter(F.col("n_non_null") == 0).select("column_name")
