"""Connected components of a link table, as Spark joins and groupings.

Alternating large-star and small-star steps (a published MapReduce method):
each node's larger, then smaller, neighbours are rewired to the smallest node
of its neighbourhood, until the links are stars around component minima.  Hubs
are reduced map-side first; every round is written to the shared folder, in as
many files as its links need (``LINKS_A_FILE``), not as the session has partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import forget, written


LINKS_A_FILE = 20_000


def _large_star(links: DataFrame, label: str, files: int) -> tuple[DataFrame, DataFrame]:
    """The rewired links, and the written table of least neighbours they read."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written, so that the join below is one of two plain exchanges: Spark can
    # then split the rows of a hub, which an aggregate in between would prevent.
    low = written(both.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("node"), F.least("u", "low").alias("low")).coalesce(files), f"{label}-low")
    # u's neighbours above u go to the least of u's neighbourhood.
    moved = both.where("v > u").join(low, F.col("u") == F.col("node")).select(
        F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.distinct(), low


def _small_star(links: DataFrame) -> DataFrame:
    low = links.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "node")
    joined = links.join(low, F.col("u") == F.col("node"))
    # u and its neighbours below u go to the least of these.
    pairs = F.array(F.struct(F.col("u").alias("u"), F.col("low").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("low").alias("v")))
    return (joined.select(F.explode(pairs).alias("p")).select("p.u", "p.v")
            .where("u > v").distinct())


def _state(links: DataFrame):
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """(node, component) for every node of ``links`` (u, v) that is not its
    component's minimum; ``component`` is the minimum.

    Nulls, loops and repeated links are dropped first."""
    now = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), label)
    state = _state(now)
    while state[0]:
        then, before = now, state
        files = 1 + state[0] // LINKS_A_FILE
        rewired, low = _large_star(then, label, files)
        now = written(_small_star(rewired).coalesce(files), label)
        state = _state(now)
        forget(then)
        forget(low)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
