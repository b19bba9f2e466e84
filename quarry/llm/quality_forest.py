"""Quality rules: rule statistics of whole texts and an isolation forest on them.

The base rules count words, symbols, repeated lines and repeated three-word
windows.  Of each further statistic the distance from what good rows usually show
goes into an isolation forest of random splits grown on labelled rows: a usual
text has none and shares its leaf with most others, a text that breaks a rule is
soon alone, and its average path is short.  ``USUAL`` of the labelled good rows
lie under the upper limit; the lower one is as far again below the median as
the value that ``USUAL`` of them lie over.  Two things are not seen: unusual
combinations inside the limits, and distances in a statistic in which no sampled
row has one.  The path-score threshold is
calibrated on labelled rows of both classes, a lost good row weighing ten
rejections missed; where the base rules already fail all bad ones, ``USUAL`` of
the good rows score under it.

The forest and the threshold come from a bounded sample (``SAMPLE_ROWS`` rows
of each class, lowest hash of the id first, held-out fold excluded); every text
is measured whole and scored.

Defined results: a null or empty text has no words and fails the base rules; a
null id is kept and never learnt from; repeated rows are judged alike, and a score
equal to the threshold is kept; without
labelled rows of both classes, or with fewer than two good ones that pass the
base rules, only these decide; an empty table gives no rows; other columns are
left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 3000  # labelled rows of each class that forest and threshold may use
USUAL = 0.999       # share of good rows that shows no excess in a statistic

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_CALLS = b"!?"
_DIGITS = b"0123456789"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words covered by a window of ``width`` words that the text has twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code = ids[:n]
    for i in range(1, width):
        # Renumbered after every word, so codes stay small for any text.
        _, code = np.unique(code * len(number) + ids[i:i + n], return_inverse=True)
    again = np.bincount(code)[code] > 1
    covered = np.zeros(len(words), bool)
    for i in range(width):
        covered[i:i + n] |= again
    return int(covered.sum())


def measure(text: str | None) -> list[float]:
    """The base statistics, then those only the forest sees."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]

    def count(chars: bytes) -> int:
        return len(raw) - len(raw.translate(None, chars))

    chars = len(text) - count(_SPACE)
    base = [len(words), chars, count(_SYMBOLS), len(lines) - len(set(lines)), repeated_words(words)]
    return [*base, count(_CAPITALS), count(_CALLS), count(_DIGITS), len(set(words)), max(len(lines), 1)]


def features(stats: np.ndarray) -> np.ndarray:
    """Shares that do not depend on a text's length."""
    words, chars, symbols, dup_lines, repeats, capitals, calls, digits, distinct, lines = stats.T
    n, c = np.maximum(words, 1), np.maximum(chars, 1)
    return np.stack([chars / n, symbols / c, dup_lines / lines, repeats / n, capitals / c, calls / n,
                     digits / c, np.log1p(n / np.maximum(distinct, 1))], 1)


def mean_path(n: float) -> float:
    """Average path length of an unsuccessful search among n points."""
    return 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def outside(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How far each feature is over or under the limits; 0 within them."""
    return np.maximum(points - high, 0) + np.maximum(low - points, 0)


@dataclass
class Forest:
    """Trees as arrays (tree, node): split feature (-1: leaf), split value, path length at a leaf."""

    feature: np.ndarray
    value: np.ndarray
    path: np.ndarray
    norm: float
    usual: np.ndarray  # of each feature, what good rows stay under
    low: np.ndarray    # and over
    threshold: float = 1.0

    @classmethod
    def grow(cls, points: np.ndarray, usual: np.ndarray, trees: int = 128, sample: int = 256, depth: int = 10,
             seed: int = 11, low: np.ndarray | None = None) -> Forest:
        rng = np.random.default_rng(seed)
        low_limit = np.full(points.shape[1], -np.inf) if low is None else low
        points = outside(points, low_limit, usual)
        nodes = 2 ** (depth + 1)
        feature = np.full((trees, nodes), -1, np.int16)
        value, path = np.zeros((trees, nodes)), np.zeros((trees, nodes))
        size = min(sample, len(points))
        for t in range(trees):
            stack = [(1, 0, points[rng.choice(len(points), size, replace=False)])]
            while stack:
                node, level, own = stack.pop()
                low, high = own.min(0), own.max(0)
                open_to = np.flatnonzero(high > low)
                path[t, node] = level + mean_path(len(own))
                if level < depth and len(own) > 1 and len(open_to):
                    f = rng.choice(open_to)
                    cut = rng.uniform(low[f], high[f])
                    feature[t, node], value[t, node] = f, cut
                    left = own[:, f] <= cut
                    stack += [(2 * node, level + 1, own[left]), (2 * node + 1, level + 1, own[~left])]
        return cls(feature, value, path, mean_path(size), usual, low_limit)

    def scores(self, points: np.ndarray) -> np.ndarray:
        """Anomaly of each point in (0, 1): 2 ** (-mean path / norm)."""
        points = outside(points, self.low, self.usual)
        trees = np.arange(len(self.feature))
        node = np.ones((len(points), len(trees)), np.int32)
        row = np.arange(len(points))[:, None]
        while True:
            f = self.feature[trees, node]
            inner = f >= 0
            if not inner.any():
                break
            right = points[row, np.maximum(f, 0)] > self.value[trees, node]
            node = np.where(inner, 2 * node + right, node)
        return 2 ** (-self.path[trees, node].mean(1) / max(self.norm, 1e-9))

    def calibrate(self, points: np.ndarray, good: np.ndarray, good_cost: float = 10.0) -> None:
        """The threshold with the least cost on labelled rows, a lost good row
        counting ``good_cost`` lost rejections (per share of its class); without
        bad rows, what ``USUAL`` of the good ones score under."""
        s = self.scores(points)
        if good.all():
            self.threshold = float(np.quantile(s, USUAL))
            return
        cuts = np.unique(s)
        cuts = np.r_[cuts[0] - 1e-9, (cuts[1:] + cuts[:-1]) / 2, cuts[-1] + 1e-9]
        g, b = np.sort(s[good]), np.sort(s[~good])
        lost = 1 - np.searchsorted(g, cuts, "right") / len(g)
        missed = np.searchsorted(b, cuts, "right") / len(b)
        cost = good_cost * lost + missed
        at = np.flatnonzero(cost <= cost.min() + 1e-12)
        self.threshold = float(cuts[at[len(at) // 2]])


def base_failed(stats: np.ndarray) -> np.ndarray:
    """Fewer than 50 words, or over half of them in repeated windows."""
    return (stats[:, 0] < 50) | (100 * stats[:, 4] > 50 * stats[:, 0])


def _measured(texts) -> np.ndarray:
    return np.array([measure(t if isinstance(t, str) else None) for t in texts], float).reshape(-1, 10)


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = SAMPLE_ROWS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Forest | None:
    """Forest and threshold from labelled rows; None without both classes or
    without two good rows that pass the base rules.

    With contrary labels for an id the lower counts."""
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
              .where(F.col("id").isNotNull() & F.col("label").isin(0, 1)
                     & (F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0))
              .groupBy("id").agg(F.min("label").alias("label")).withColumn("turn", F.xxhash64("id")))
    sample = None
    for label in (0, 1):
        part = marked.where(F.col("label") == label).orderBy("turn", "id").limit(rows_per_class)
        sample = part if sample is None else sample.unionByName(part)
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(sample), "id")  # at most twice rows_per_class rows
            .select("turn", "label", _stats_column("text").alias("stats")).collect())
    rows.sort(key=lambda r: (r["turn"], r["stats"]))
    stats = np.array([r["stats"] for r in rows], float).reshape(-1, 10)
    good = np.array([r["label"] == 1 for r in rows], bool)
    judged = ~base_failed(stats)  # the forest only judges what the base rules pass
    if good.all() or good[judged].sum() < 2:
        return None
    stats, good = stats[judged], good[judged]
    points = features(stats)
    low, mid, high = np.quantile(points[good], (1 - USUAL, 0.5, USUAL), axis=0)
    forest = Forest.grow(points, high, low=2 * low - mid)
    forest.calibrate(points, good)
    return forest


def _stats_column(text_col: str):
    @F.pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_measured(texts)))

    return stats(F.col(text_col))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          **options) -> DataFrame:
    """doc_id, the base statistics, base_failed, anomaly, kept of every document."""
    forest = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            stats = _measured(batch["text"])
            failed = base_failed(stats)
            score = forest.scores(features(stats)) if forest and len(stats) else np.zeros(len(stats))
            out = pd.DataFrame(stats[:, :5].astype("int64"), columns=list(BASE))
            out.insert(0, "doc_id", batch["doc_id"].values)
            yield out.assign(base_failed=failed, anomaly=score,
                             kept=~failed & (score <= (forest.threshold if forest else 1.0)))

    counts = ", ".join(f"{c} long" for c in BASE)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(
        run, f"doc_id {id_type}, {counts}, base_failed boolean, anomaly double, kept boolean")
