"""Semi-joins that leave most of a fact where it is.

Both sides of a large semi-join are shuffled whole, although few rows of the
fact have a match.  Here the keys of the small side first become a filter of
fixed size: one bit per hash value, 64 to a word, built by a group-by with
map-side partial results.  The words set, at most ``bits / 64`` rows of two
numbers, are broadcast, and a task drops a fact row whose bit is not set before
it is shuffled.  The exact semi-join then runs over what is left.

A key passes wrongly with a probability of at most keys / bits, so the filter
serves while the keys are fewer than the bits, and is of no use, but right, beyond.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.joins import semi

BITS = 1 << 24  # 2**18 words of 16 bytes: 4 MB


def key_words(keys: DataFrame, on: Sequence[str], bits: int = BITS) -> DataFrame:
    """_word, _mask: the bits of all keys, at most ``bits / 64`` rows."""
    spot = F.pmod(F.xxhash64(*on), F.lit(bits))
    return keys.select(F.floor(spot / 64).alias("_word"), (spot % 64).cast("int").alias("_bit")).groupBy("_word").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit"))).alias("_mask"))


def may_match(left: DataFrame, right: DataFrame, on: Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows of ``left`` whose key's bit is set, without a shuffle of them."""
    if bits < 64 or bits & (bits - 1):
        raise ValueError("bits is a power of two, 64 or more")
    spot = F.pmod(F.xxhash64(*on), F.lit(bits))
    known = F.broadcast(key_words(right, on, bits))  # at most bits / 64 rows of two numbers
    rows = left.withColumn("_spot", spot).join(known, F.floor(F.col("_spot") / 64) == F.col("_word"))
    bit = F.call_function("shiftrightunsigned", F.col("_mask"), (F.col("_spot") % 64).cast("int"))
    return rows.where(bit.bitwiseAND(F.lit(1).cast("long")) == 1).select(*left.columns)


def filtered_semi(left: DataFrame, right: DataFrame, on, bits: int = BITS) -> DataFrame:
    """Rows of ``left`` with a match in ``right`` on columns of one name (EXISTS)."""
    keys = [on] if isinstance(on, str) else list(on)
    return semi(may_match(left, right, keys, bits), right, keys)
