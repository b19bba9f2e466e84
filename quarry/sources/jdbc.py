"""Reading a table from a live SQL server (S1 for the original databases).

Only a reader: the options are the standard ``jdbc`` data source ones.  A
numeric ``partition_column`` with bounds splits the read into parallel range
queries instead of a single connection pulling the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, *, user: str | None = None,
               password: str | None = None, partition_column: str | None = None,
               lower_bound: int | None = None, upper_bound: int | None = None,
               num_partitions: int = 64, fetch_size: int = 10_000) -> DataFrame:
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", fetch_size))
    if user is not None:
        reader = reader.option("user", user)
    if password is not None:
        reader = reader.option("password", password)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError("a partitioned read needs lower_bound and upper_bound")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions))
    return reader.load()
