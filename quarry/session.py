"""Session construction and the shared working folder.

On a cluster the session comes from the platform; ``build_session`` is for
tests, the bench and local runs.  It only sets what a laptop run needs and
leaves every cluster-level setting to ``spark-defaults`` when present.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every run wants, whatever the scale.
_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch sort-merge to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session configured for the quarry reports."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach: the cluster's checkpoint directory.

    The cluster names it in ``spark.checkpoint.dir``.  Where it is unset, a
    local master (driver and tasks are one process) gets a temporary folder;
    on a cluster that folder would differ from machine to machine, so there
    the call fails.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    return "/".join([base, *parts]) if parts else base


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver's JVM delete a scratch folder, if it exists by then, when it ends."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut, and a
    lost executor costs its running tasks only.  The folder goes with the driver."""
    spark = df.sparkSession
    path = shared_dir(spark, unique_name(label))
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def unique_name(prefix: str) -> str:
    """A collision-free folder name for one job's output."""
    return f"{prefix}-{os.getpid()}-{os.urandom(4).hex()}"
