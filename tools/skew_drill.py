"""Skew drill: derive a skewed copy of a table set and run reports against the oracle on it.

A third of ``lineitem`` is re-keyed to one supplier, one part and one order, and
a third of ``events`` to one user; the other tables are copied unchanged.
The copy is written under a fresh folder (``--out``, default a new temp dir),
then every report (or the named ones) is compared with its SQL oracle on it,
with AQE's skew thresholds lowered so the skew handling actually triggers.

    python tools/skew_drill.py [--sf /root/testdata/sf0.01] [--out DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import subprocess
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def derive(spark, src: str, out: str) -> None:
    from pyspark.sql import functions as F

    for t in TABLES:
        df = spark.read.parquet(f"{src}/{t}.parquet")
        if t == "lineitem":
            hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(3)) == 0
            df = (df.withColumn("l_suppkey", F.when(hot, F.lit(0).cast("long")).otherwise(F.col("l_suppkey")))
                  .withColumn("l_partkey", F.when(hot, F.lit(1).cast("long")).otherwise(F.col("l_partkey")))
                  .withColumn("l_orderkey", F.when(hot, F.lit(2).cast("long")).otherwise(F.col("l_orderkey"))))
        elif t == "events":
            hot = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
            df = df.withColumn("user_id", F.when(hot, F.lit(7).cast("long")).otherwise(F.col("user_id")))
        # Facts as several files: AQE splits a skewed partition along map-task
        # boundaries, so a one-file table could never be split.
        n = 8 if t in ("lineitem", "events", "orders") else 1
        df.repartition(n).write.mode("error").parquet(f"{out}/{t}.parquet")


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=None)
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    out = args.out or tempfile.mkdtemp(prefix="quarry-skew-")
    from quarry.session import build_session

    spark = build_session("local[8]", 8)
    derive(spark, args.sf.rstrip("/"), out)
    spark.stop()
    env = dict(os.environ, QUARRY_SKEW_DRILL="1")
    cmd = [sys.executable, os.path.join(os.path.dirname(__file__), "check_oracle.py"), "--sf", out, *args.names]
    print("skewed copy:", out, flush=True)
    sys.exit(subprocess.call(cmd, env=env))


if __name__ == "__main__":
    main()
