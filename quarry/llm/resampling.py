"""Importance resampling of documents towards a target distribution.

A document's features are all runs of one to three consecutive words, hashed to
a fixed number of buckets.  A bucket's gain is the log ratio of its smoothed
shares of the target's and of the corpus's features; a document's weight is the
sum over its features, and Gumbel noise from a hash of its id makes the highest
scores a draw without replacement by weight.

Features are never strings.  A text's UTF-8 bytes are one array; a CRC-32 is
linear, so a word's is the exclusive or of one table entry a byte, and that of
"a b" follows from those of "a" and "b" and the length of "b".  Texts are taken
``CHUNK`` bytes at a time, a longer one in pieces that overlap by two words.

The corpus's counts are sums over all documents.  The scores are written, and
the cutoff is found by bisection: exact counts over the written scores, several
probes a job, then likewise over the ids tied at the cutoff.  No sort sees
unselected rows, and no row passes the driver.  Selected rows are sorted by
range; a rank is the place in its range plus the rows of the ranges before.

Defined results: a null text has no words; a null id counts as the empty string
in the hash and is tied after all others; repeated rows score alike and are
drawn each on its own, as many as there is room for at the cutoff; without
target texts, or an empty table, the counts are 0 (no rows give no rows); ids
are whole numbers; other columns are left out.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import forget, small, written

BUCKETS = 10_000
CHUNK = 1 << 18   # bytes of text whose words are arrays at a time
PROBES = 15       # thresholds counted in one job of a bisection

# -- checksums of runs of words ----------------------------------------------------

_SHORT = 64


def _byte_table() -> np.ndarray:
    """CRC-32's table, from its bit rule."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_BYTE = _byte_table()


def _zero_byte(crc: np.ndarray) -> np.ndarray:
    return _BYTE[crc & 255] ^ (crc >> 8)


def _stepped(first: np.ndarray, times: int) -> np.ndarray:
    """Rows 0 to ``times``: ``first`` advanced by so many zero bytes."""
    rows = [first]
    for _ in range(times):
        rows.append(_zero_byte(rows[-1]))
    return np.stack(rows)


#: What a byte adds to the checksum if so many bytes of its word follow.
_ADDS = _stepped(_BYTE, _SHORT).ravel()
#: What the length alone adds.
_START = _stepped(np.array([0xFFFFFFFF], np.uint32), _SHORT)[:, 0] ^ np.uint32(0xFFFFFFFF)
#: The four bytes of a checksum, each advanced by so many zero bytes.
_STEP = _stepped((np.arange(256, dtype=np.uint32)[None] << (8 * np.arange(4, dtype=np.uint32)[:, None])).ravel(),
                 _SHORT).ravel()
_SPACE = np.uint32(zlib.crc32(b" "))


def _apply(table: np.ndarray, crc: np.ndarray, base=0) -> np.ndarray:
    return (table[base + (crc & 255)] ^ table[base + 256 + (crc >> 8 & 255)]
            ^ table[base + 512 + (crc >> 16 & 255)] ^ table[base + 768 + (crc >> 24)])


def advance(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums after ``length`` zero bytes each."""
    out = _apply(_STEP, crc.astype(np.int64), (length % _SHORT) * 1024)
    high, table = length // _SHORT, _STEP[_SHORT * 1024:]
    while high.any():
        odd = (high & 1).astype(bool)
        out[odd] = _apply(table, out[odd].astype(np.int64))
        high, table = high >> 1, _apply(table, table.astype(np.int64))
    return out


def _lower_table() -> np.ndarray:
    """Each byte as it stands in a word, lower-cased; 0 for those of none."""
    t = np.zeros(256, np.uint8)
    for low, high in ((48, 57), (97, 122), (128, 255)):
        t[low:high + 1] = np.arange(low, high + 1)
    t[65:91] = np.arange(97, 123)
    return t


_LOWER = _lower_table()


class Words:
    """The words of some texts that lie one after another in ``data``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.low = _LOWER[data]
        inside = self.low > 0
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        gap = ~inside
        first, last = inside.copy(), inside.copy()
        first[1:] &= gap[:-1] | edge[1:-1]
        last[:-1] &= gap[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(bounds, self.start, "right") - 1
        self.inside = inside

    def checksums(self) -> np.ndarray:
        length = self.end - self.start
        if not len(length):
            return np.zeros(0, np.uint32)
        at = np.flatnonzero(self.inside)
        follow = np.repeat(self.end, length) - at - 1
        adds = _ADDS[np.minimum(follow, _SHORT) * 256 + self.low[at]]
        out = np.bitwise_xor.reduceat(adds, np.cumsum(length) - length) ^ _START[np.minimum(length, _SHORT)]
        for i in np.flatnonzero(length > _SHORT):
            out[i] = zlib.crc32(self.low[self.start[i]:self.end[i]].tobytes())
        return out

    def features(self, known: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, checksum) of the runs of 1, 2 and 3 words that do not end in
        the first ``known`` words."""
        run, length = self.checksums(), self.end - self.start
        after = advance(np.full(len(run), _SPACE), length) ^ run  # of a space and the word
        yield self.text[known:], run[known:]
        for n in (1, 2):
            run = advance(run[:-1], length[n:] + 1) ^ after[n:]
            whole = self.text[n:] == self.text[:-n]
            whole[:max(known - n, 0)] = False
            yield self.text[:-n][whole], run[whole]


def _spans(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, Words, int]]:
    """(number of its first text, words, how many of them an earlier span had)."""
    i = 0
    while i < len(bounds) - 1:
        j = int(np.searchsorted(bounds, bounds[i] + CHUNK, "right")) - 1
        if j > i:
            yield i, Words(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]), 0
            i = j
            continue
        at, cut, stop, known = int(bounds[i]), int(bounds[i]), int(bounds[i + 1]), 0
        while cut < stop:
            cut = min(cut + CHUNK, stop)
            while cut < stop:  # up to the next place between words
                gap = np.flatnonzero(_LOWER[data[cut:min(cut + CHUNK, stop)]] == 0)
                if len(gap):
                    cut += int(gap[0])
                    break
                cut = min(cut + CHUNK, stop)
            words = Words(data[at:cut], np.array([0, cut - at]))
            yield i, words, known
            known = min(2, len(words.start))
            at = at + int(words.start[-known]) if known else cut
        i += 1


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), bounds


# -- counts and weights ----------------------------------------------------------

def feature_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, words, known in _spans(*_texts(batch.column(0))):
                for _, crc in words.features(known):
                    held += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["bucket", "n"])

    rows = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    s_all, t_all = float(corpus.sum()) + len(corpus), float(target.sum()) + len(target)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def score(docs: DataFrame, gain: np.ndarray, seed: int = 42, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for first, part, known in _spans(*_texts(batch.column("text"))):
                for runs, (text, crc) in enumerate(part.features(known)):
                    if len(text):
                        count = np.bincount(text)
                        # Sums of whole numbers below 2**53: exact.
                        total = np.bincount(text, gain[crc % np.uint32(buckets)]).astype(np.int64)
                        here = slice(first, first + len(count))
                        features[here] += count
                        weight[here] += total
                        if not runs:
                            words[here] += count
            noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
                     for h in batch.column("h").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(features), pa.array(weight),
                 pa.array(weight + np.array(noise, np.int64))], names)

    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    kind = docs.schema[id_col].dataType.simpleString()
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), h.alias("h"), F.col(text_col).alias("text")).mapInArrow(
        weigh, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


# -- the draw ------------------------------------------------------------------------

def bisect(rows: DataFrame, column: str, least: int) -> int:
    """The largest ``c`` such that at least ``least`` rows have ``column`` >= c,
    by exact counts over ``rows``, which must have so many."""
    ends = rows.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    low, high = ends["low"], ends["high"]
    while low < high:
        width = high - low
        probes = sorted({low + max(1, -(-width * i // (PROBES + 1))) for i in range(1, PROBES + 1)} | {high})
        held = rows.agg(*[F.count_if(F.col(column) >= F.lit(p)).alias(f"p{i}") for i, p in enumerate(probes)]).first()
        enough = [p for i, p in enumerate(probes) if held[i] >= least]
        missed = [p for i, p in enumerate(probes) if held[i] < least]
        low = enough[-1] if enough else low
        high = missed[0] - 1 if missed else high
    return low


def draw(scored: DataFrame, k: int) -> DataFrame:
    """Adds rank to a written table of scores: 1 to ``k`` for its ``k`` highest
    scores among rows marked ``eligible``, ties to the smaller doc_id; else null."""
    columns = [c for c in scored.columns if c != "eligible"]
    if not k:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    pool = scored.where("eligible")
    cutoff = bisect(pool, "score", k)
    tied = pool.where((F.col("score") == cutoff) & F.col("doc_id").isNotNull()).select(
        F.negate("doc_id").alias("turn"))
    room = k - pool.where(F.col("score") > cutoff).count()
    chosen = F.col("eligible") & (F.col("score") >= cutoff)
    if tied.count() >= room:
        last = -bisect(tied, "turn", room)
        chosen &= (F.col("score") > cutoff) | F.coalesce(F.col("doc_id") <= last, F.lit(False))
    # Rows alike in all are spread by where they stand in the written table.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("spread")]
    ranges = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = scored.where(chosen).withColumn("spread", F.monotonically_increasing_id())
    # Rows of a range count upwards from the range's number times 2**33.
    sorted_rows = written(picked.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(
        *columns, F.monotonically_increasing_id().alias("at")), "resample-drawn")
    part = F.shiftright("at", 33)
    counts = sorted_rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # one row a range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
                      "resample-ranges")
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    ranked = sorted_rows.withColumn("part", part).join(small(offsets), "part").select(
        *columns, F.when(rank <= k, rank).alias("rank"))
    rest = scored.where(~chosen).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
             buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document."""
    gain = gains(feature_counts(docs, text_col, buckets), feature_counts(target, target_text_col, buckets))
    scored = written(score(docs, gain, seed, id_col, text_col).withColumn(
        "eligible", F.col("n_words") >= least_words), "resample-scores")
    n = scored.where("eligible").count()
    return draw(scored, percent * n // 100)
