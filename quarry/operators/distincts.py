"""Distinct counts that merge (A3, D1): exact bitmaps and HLL sketches per period.

``COUNT(DISTINCT a), COUNT(DISTINCT b)`` plans an Expand, one copy of every row
for each column, and its result cannot be added up over months.  Here a month
is reduced once to a small table, and any longer period is a union of rows of
that table.

* ``bitmap_table``: exact, for whole-number ids.  An id's bucket (32,768 ids)
  and bit give one 4 KB bitmap per (period, column, bucket); partial bitmaps
  are merged map-side.  Best for compact ids, as surrogate keys are: ids spread
  over all of 64 bits make a bitmap for every few of them.
* ``SketchStore``: within some tenths of a percent, for any type.  Sketches are
  kept per month in a folder; a refresh computes the months that are not there
  and reads no others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WHOLE = {"tinyint", "smallint", "int", "bigint"}


# -- exact ---------------------------------------------------------------------------

def bitmap_table(df: DataFrame, period: Mapping[str, Column], ids: Mapping[str, str]) -> DataFrame:
    """One row per (period columns, kind, bucket) with the bitmap of the ids seen.

    ``ids`` maps the name of a kind to its id column; NULL ids are not counted."""
    kinds = dict(df.dtypes)
    for column in ids.values():
        if kinds[column] not in _WHOLE:
            raise TypeError(f"{column} is not a whole number")
    # One pass for all kinds; the pair (kind, id) is narrow and is reduced in the same task.
    pairs = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("id"))
                                for kind, c in ids.items()]))
    rows = df.select(*[c.alias(name) for name, c in period.items()], pairs.alias("pair")).select(
        *period, "pair.*").where("id IS NOT NULL")
    return rows.groupBy(*period, "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merge_bitmaps(table: DataFrame, *periods: str) -> DataFrame:
    """A bitmap table over longer periods: those columns of ``table`` that stay."""
    return table.groupBy(*periods, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(table: DataFrame, kinds: Sequence[str], *periods: str) -> DataFrame:
    """Distinct ids per period, one column per kind (0 where a kind has none)."""
    counts = [F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bits"))), F.lit(0)).alias(kind)
              for kind in kinds]
    return merge_bitmaps(table, *periods).groupBy(*periods).agg(*counts)


# -- sketches ------------------------------------------------------------------------

LG_K = 15  # registers of a sketch: 2**15, a standard error of 0.6 %


def _hashed(df: DataFrame, column: str) -> Column:
    """A column's value as a 64-bit hash, NULL staying NULL; 0.0 and -0.0 are one."""
    c = F.col(column)
    if dict(df.dtypes)[column] in ("float", "double"):
        c = c + F.lit(0.0)
    return F.when(c.isNotNull(), F.xxhash64(c))


def sketches(df: DataFrame, columns: Sequence[str], *periods: str) -> DataFrame:
    """Per period and column: rows, NULLs and a sketch of the distinct values."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}"),
                 F.hll_sketch_agg(_hashed(df, c), F.lit(LG_K)).alias(f"sketch_{i}")]
    per_period = df.groupBy(*periods).agg(*aggs)
    return per_period.select(*periods, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("n_rows"), F.col(f"nulls_{i}").alias("n_nulls"),
                 F.col(f"sketch_{i}").alias("sketch")) for i, c in enumerate(columns)])).alias("s")).select(
                     *periods, "s.*")


def merged_profile(table: DataFrame, *periods: str) -> DataFrame:
    """Rows, NULLs and estimated distinct values per column (and period) of a table of sketches."""
    return table.groupBy(*periods, "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


class SketchStore:
    """Sketches per calendar month of a fact, in a folder of Parquet files.

    The folder is a table partitioned by month; Spark moves a month's folder into
    place when all tasks of a write have finished, so it is there whole or not at all."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], ts: str):
        self.spark, self.path, self.columns, self.ts = spark, path, list(columns), ts

    def months(self) -> list:
        """The months held, as dates of their first days, from the folder's listing."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []
        return sorted(date.fromisoformat(n.removeprefix("month=")) for n in names if n.startswith("month="))

    def refresh(self, fact: DataFrame, again: Sequence = ()) -> None:
        """Add the months of ``fact`` that are not held, and compute those of ``again`` anew.

        Held months become ranges of the timestamp that the scan leaves out, so
        that files and row groups of those months are skipped by their statistics."""
        skip = [m for m in self.months() if m not in set(again)]
        rows = fact.where(F.col(self.ts).isNotNull())
        for first, after in _ranges(skip):
            rows = rows.where((F.col(self.ts) < F.lit(first).cast("timestamp_ntz"))
                              | (F.col(self.ts) >= F.lit(after).cast("timestamp_ntz")))
        out = sketches(rows.withColumn("month", F.trunc(self.ts, "month").cast("date")), self.columns, "month")
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month")
         .parquet(self.path))

    def read(self) -> DataFrame:
        return self.spark.read.schema(
            "column_name string, n_rows long, n_nulls long, sketch binary, month date").parquet(self.path)

    def profile(self, *periods: str) -> DataFrame:
        return merged_profile(self.read(), *periods)


def _ranges(months: Sequence) -> list[tuple]:
    """(first day, first day after) of runs of neighbouring months."""
    out: list[list] = []
    for m in sorted(months):
        after = m.replace(year=m.year + m.month // 12, month=m.month % 12 + 1)
        if out and out[-1][1] == m:
            out[-1][1] = after
        else:
            out.append([m, after])
    return [tuple(r) for r in out]
