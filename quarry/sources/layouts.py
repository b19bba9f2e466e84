"""Copies of a table in another physical layout, used only while they match it.

A copy states the fingerprint of the files it was made from, written after its
data.  Readers compare it with the table as it is now: a copy that is stale,
half-written or of another table is not used, and the table itself is read.

* by month: folders ``part_year=/part_month=`` (see ``sinks.write_by_month``);
* by key: bucketed and sorted on a join key.  Two tables bucketed alike join
  bucket by bucket, without a shuffle of either fact (J1, X9).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from quarry.sources.sinks import write_by_month

_MARK = "_quarry_source"
_PROPERTY = "quarry.source"


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def fingerprint(spark: SparkSession, path: str) -> str | None:
    """A digest of names, lengths and times of the files under ``path``; None without any."""
    files, where = _files(spark, path)
    if not files.exists(where):
        return None
    found, each = [], files.listFiles(where, True)
    while each.hasNext():
        f = each.next()
        if not f.getPath().getName().startswith(("_", ".")):
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest() if found else None


# -- by month ------------------------------------------------------------------------

def publish_by_month(spark: SparkSession, source: str, ts_col: str, path: str) -> str:
    """Write ``source`` by month to ``path`` and, when that is done, say what it was made from."""
    made_from = fingerprint(spark, source)
    write_by_month(spark.read.parquet(source), path, ts_col)
    files, mark = _files(spark, f"{path}/{_MARK}")
    out = files.create(mark, True)
    out.writeBytes(made_from or "")
    out.close()
    return path


def by_month_is_current(spark: SparkSession, source: str, path: str) -> bool:
    files, mark = _files(spark, f"{path}/{_MARK}")
    if not files.exists(mark):
        return False
    stated = spark._jvm.org.apache.commons.io.IOUtils.toString(files.open(mark), "UTF-8")
    return bool(stated) and stated == fingerprint(spark, source)


# -- by key --------------------------------------------------------------------------

def bucketed_name(source: str, key: str) -> str:
    """The catalogue name of the copy of a table bucketed by ``key``."""
    return f"quarry_{key}_{hashlib.sha256(source.encode()).hexdigest()[:12]}"


def publish_bucketed(spark: SparkSession, source: str, key: str, buckets: int, path: str) -> str:
    """Write ``source`` bucketed and sorted by ``key``; returns the table's name.

    Each bucket is one task's, so it is one file, which keeps the order.  Choose
    ``buckets`` so that a bucket of the larger table fits an executor's memory
    for a sort, and the same for all tables that are to be joined."""
    name, made_from = bucketed_name(source, key), fingerprint(spark, source)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (spark.read.parquet(source).repartition(buckets, key).write.format("parquet").mode("overwrite")
     .option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PROPERTY}' = '{made_from}')")
    return name


def bucketed(spark: SparkSession, source: str, key: str) -> DataFrame | None:
    """The copy of a table bucketed by ``key``, if there is one and it is current."""
    name = bucketed_name(source, key)
    if not spark.catalog.tableExists(name):
        return None
    stated = spark.sql(f"SHOW TBLPROPERTIES {name}").where(f"key = '{_PROPERTY}'").collect()  # one row at most
    if not stated or stated[0]["value"] != fingerprint(spark, source):
        return None
    return spark.table(name)
