"""Sharding [native]: contiguous shards of near-equal bytes by global prefix sums.

Rows are put in one global order, (content hash, document id), so that equal
texts lie side by side.  The order is range-partitioned into blocks; each
block's byte and row totals give the block's offset in the whole; a running sum
inside the block gives every row its global byte interval.  Shard ``k`` owns
the rows whose interval's midpoint lies in the ``k``-th of ``shards`` equal
parts of all bytes, so a shard misses its target by at most one document.

Only built-in functions are used.  A content that holds a third of all rows is
spread over several blocks because the document id is part of the order.

Defined results: a null text has no bytes (size 1, checksum 0); null ids sort
first; repeated rows each get their own place; an empty table gives no rows;
other input columns, whatever their names, are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written

_ORDER = ("hash", "doc_id", "size")


def shard_by_bytes(docs: DataFrame, shards: int = 16, blocks: int | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (place in the shard), start_byte.

    ``blocks`` is the number of range partitions of the global order (default:
    the session's shuffle partitions); the block totals are the only small
    table, one row per block.
    """
    spark = docs.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long").alias("hash"))
    # Range bounds are sampled, so the blocks are written once: every later
    # step must see the same cut.
    ranged = written(rows.repartitionByRange(blocks, *_ORDER)
                     .withColumn("block", F.spark_partition_id()), "shard-blocks")

    totals = ranged.groupBy("block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "block",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.orderBy("block").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_bytes"))

    inside = Window.partitionBy("block").orderBy(*_ORDER)
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (ranged
              .withColumn("running", running)
              .withColumn("place", F.row_number().over(inside).cast("long") - 1)
              .join(F.broadcast(offsets), "block")  # one row per block
              .withColumn("start_byte", F.col("bytes_before") + F.col("running") - F.col("size"))
              .withColumn("rank", F.col("rows_before") + F.col("place")))
    # Whole-number arithmetic in decimals: bytes times shards may pass 2**63.
    placed = placed.withColumn("shard", F.expr(
        f"cast(least({shards - 1}, cast(2 * start_byte + size as decimal(25,0)) * "
        f"cast({shards} as decimal(10,0)) div cast(2 * all_bytes as decimal(25,0))) as int)"))
    first = placed.groupBy("shard").agg(F.min("rank").alias("first_rank"))  # one row per shard
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("rank") - F.col("first_rank")).alias("slot"), "start_byte"))
