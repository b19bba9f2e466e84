"""Joins that cannot silently explode.

Rules the helpers enforce:
* a broadcast hint is only given after the side's estimated size was checked
  against a bound (``broadcast_if_small``); beyond the bound the plan stays a
  shuffle join, and AQE may still switch at runtime from real sizes;
* existence tests (semi/anti) first reduce the other side to its distinct
  keys, so a hot key becomes one row before it is shuffled;
* many-to-many questions are answered from per-key counts (``fanout``) or
  per-key aggregates, never by emitting all pairs of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest side we hint for broadcast, by its estimated (encoded) size: every
# executor holds a copy, and in memory it may be several times as large.
DEFAULT_BROADCAST_BYTES = 16 * 1024 * 1024


def _keys(on) -> list[str]:
    if on is None:
        return []
    return [on] if isinstance(on, str) else list(on)


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate for ``df``'s optimized plan (None if unknown).

    This is the statistic Spark's own ``autoBroadcastJoinThreshold`` check uses:
    file sizes scaled by the pruned columns, exact row bounds after a LIMIT.
    """
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # noqa: BLE001 - no JVM plan (e.g. Connect): treat as unknown
        return None
    # py4j hands a Scala BigInt over as a Python int; keep a string path for other bridges.
    return int(size) if isinstance(size, int) else int(str(size))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast only when its estimated size is within ``max_bytes``.

    Otherwise the DataFrame is returned unhinted and the join stays a
    (skew-aware, AQE-managed) shuffle join.
    """
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def semi(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with a match in ``right`` (J10, EXISTS); no fan-out."""
    keys = _keys(on)
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` without a match in ``right`` (J9, J11, NOT EXISTS).

    NULL keys never match, so they are kept (NOT EXISTS semantics, not NOT IN).
    """
    keys = _keys(on)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def anti_by_outer_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                       side: str = "left") -> DataFrame:
    """The ``LEFT JOIN … WHERE right.key IS NULL`` form (J9), or its RIGHT mirror.

    Kept for equivalence checks; ``anti`` is the plan to use.
    """
    r = right.select(F.col(right_key).alias("_rk")).distinct()
    if side == "left":
        return left.join(r, left[left_key] == r["_rk"], "left").filter(F.col("_rk").isNull()).drop("_rk")
    return r.join(left, r["_rk"] == left[left_key], "right").filter(F.col("_rk").isNull()).drop("_rk")


def dedupe_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
                left_cols: Sequence[str] | None = None,
                right_cols: Sequence[str] | None = None) -> DataFrame:
    """De-duplicate each side on the columns it contributes, then join.

    Duplicate keys on both sides multiply (17 x 26 rows for one key); reducing
    first keeps the join output to one row per distinct combination.
    """
    keys = _keys(on)
    lcols = list(dict.fromkeys([*keys, *(left_cols or [])]))
    rcols = list(dict.fromkeys([*keys, *(right_cols or [])]))
    return left.select(*lcols).distinct().join(right.select(*rcols).distinct(), keys, how)


def fanout(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
           key_name: str = "key") -> DataFrame:
    """Rows a join would produce per key = left count x right count.

    Computed from per-key counts on each side (map-side partial aggregation),
    so a key holding a third of the data costs one row, not its product.
    """
    lc = left.groupBy(F.col(left_key).alias(key_name)).agg(F.count(F.lit(1)).alias("n_left"))
    rc = right.groupBy(F.col(right_key).alias(key_name)).agg(F.count(F.lit(1)).alias("n_right"))
    return (lc.join(rc, key_name, "inner")
            .withColumn("n_pairs", F.col("n_left") * F.col("n_right")))


def per_key(dim: DataFrame, *columns: str | Column) -> DataFrame:
    """A dimension reduced to one row per combination of ``columns``, with its
    number of rows as ``copies``.

    Joined to per-key counts of a fact, rows multiply by ``copies`` as the plain
    join would, and a distinct count of the key stays a count of rows."""
    return dim.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))


def join_back_top(fact: DataFrame, top: DataFrame, on) -> DataFrame:
    """Join a top-k result (bounded by its LIMIT) back to the fact table.

    The bounded side is broadcast; the fact side is only scanned, not shuffled.
    """
    return fact.join(broadcast_if_small(top), on, "inner")
