"""Export the *full* result of a report.

The notebooks pulled a whole result into client memory and wrote it from
there; here every task writes its own part file straight to shared storage,
so nothing passes through the driver.  ``preview`` is the bounded look.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import shared_dir, unique_name


#: What keeps text intact: everything quoted, quotes doubled, NULL spelled out,
#: so a blank string stays blank and line breaks stay inside their value.
_CSV = {"quoteAll": "true", "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "lineSep": "\n"}


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              max_records: int = 1_000_000) -> str:
    """Write every row of ``df`` as CSV part files under ``path``.

    Values may hold line breaks, so a reader cannot split a file; ``max_records``
    bounds the rows of one file instead.  ``timestamp`` text is Spark's default."""
    (df.write.mode(mode).options(**_CSV).option("header", header)
     .option("maxRecordsPerFile", max_records).csv(path))
    return path


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> str:
    """Write ``df`` as Parquet, optionally partitioned (e.g. by year, month)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_by_month(df: DataFrame, path: str, ts_col: str, mode: str = "overwrite") -> str:
    """Lay a fact out in ``part_year=/part_month=`` folders derived from ``ts_col``.

    Reports that select periods can then add :func:`month_partitions` next to
    their timestamp range, and Spark skips whole folders (partition pruning)
    before it opens a file.  Rows are range-partitioned on (year, month,
    timestamp): each task holds a contiguous slice and writes few files, and a
    month holding a third of all rows is split across many tasks instead of
    landing in one (hash-partitioning on the month would do that).
    """
    c = F.col(ts_col)
    out = df.withColumn("part_year", F.year(c)).withColumn("part_month", F.month(c))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out.repartitionByRange(n, "part_year", "part_month", ts_col).write.mode(mode).partitionBy(
        "part_year", "part_month").parquet(path)
    return path


def month_partitions(year: int | None = None, months=None, exclude: bool = False):
    """Predicate on the partition columns written by :func:`write_by_month`: a
    year, some months of it, or some months of every year."""
    cond = F.lit(True) if year is None else F.col("part_year") == F.lit(year)
    if months is not None:
        cond = cond & F.col("part_month").isin(list(months))
    return ~cond if exclude else cond


def read_csv(spark: SparkSession, path: str, schema, header: bool = True) -> DataFrame:
    """Read a CSV export back with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).options(**_CSV).option("multiLine", "true").option("header", header).csv(path)


def export_folder(spark: SparkSession, prefix: str = "export") -> str:
    """A fresh folder in the cluster's shared checkpoint location."""
    return shared_dir(spark, unique_name(prefix))


def preview(df: DataFrame, n: int = 1000) -> DataFrame:
    """The display cap of a notebook (first ``n`` rows), as a lazy DataFrame."""
    return df.limit(n)
