"""Helpers shared by the training-data operators: tables and scratch folders.

Intermediate tables are written below the folder the cluster names in
``spark.checkpoint.dir`` (see ``quarry.session.shared_dir``): a written table
cuts lineage, so a lost executor costs its running tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import shared_dir, unique_name

#: A word, as every contract of this package has it.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder."""
    return shared_dir(spark, unique_name(label))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read back."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    return back


def forget(df: DataFrame | None) -> None:
    """Delete the folder behind a ``written`` table that nothing reads any more."""
    path = getattr(df, "scratch_path", None)
    if path:
        spark = df.sparkSession
        jvm = spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


#: A table of at most this many narrow rows may be broadcast (some 10 MB).
SMALL_ROWS = 100_000


def small(df: DataFrame, entries: str | None = None) -> DataFrame:
    """Mark a written table for broadcast if it has few rows; else leave the
    join strategy to Spark.

    With an array column ``entries``, its entries must be few in all as well."""
    if entries and (df.agg(F.sum(F.size(entries))).first()[0] or 0) > SMALL_ROWS:
        return df
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df
