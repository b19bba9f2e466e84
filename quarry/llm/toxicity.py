"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character 3- to 6-grams (with edge marks), each hashed
to a row of one embedding table; unseen misspellings share most rows with the
word they stand for.  A text's vector is the average of its words' vectors; a
linear softmax over two classes gives the score.

Embeddings and softmax are trained jointly in numpy with Adam on a bounded
sample of labelled rows (``SAMPLE_ROWS`` per class, lowest hash of the id
first).  Tasks turn the sampled texts into counts of n-gram rows and add up how
often toxic and clean texts hold each; the driver picks from these sums the rows
that learn, and gets of each text those rows alone: no text goes to the driver.
Scoring needs one number per n-gram row, so the model that goes to the tasks is
``2**BUCKET_BITS`` floats, whatever the corpus.

Labels are learnt only from rows outside the held-out fold; label, language,
source and id are never inputs of a score.

Defined results: a null, empty or wordless text scores the model's value for an
empty window; whole texts are scored; a null id is not held out and never
learnt from; repeated rows score alike, and a score of exactly 0.5 is predicted 1; without labelled rows of both classes
every score is 0; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from zlib import crc32 as _crc

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import forget, written

SAMPLE_ROWS = 2000   # labelled rows of each class that a model may learn from
BUCKET_BITS = 17
_EDGES = ".,;:!?\"'()[]{}<>*_-"


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


def gram_rows(token: str, low: int = 3, high: int = 6) -> set[int]:
    """Embedding rows of a token's character n-grams."""
    word = f"<{token.strip(_EDGES)}>"
    mask = (1 << BUCKET_BITS) - 1
    raw = word.encode("utf-8", "surrogatepass")
    if len(raw) == len(word):
        return {_crc(raw[i:i + n]) & mask for n in range(low, high + 1)
                for i in range(len(word) - n + 1)} or {_crc(raw) & mask}
    return {_crc(word[i:i + n].encode("utf-8", "surrogatepass")) & mask for n in range(low, high + 1)
            for i in range(len(word) - n + 1)} or {_crc(raw) & mask}


#: Logits are this many times the average's product with the softmax weights:
#: toxic words are a few in a hundred, and their average must still decide.
GAIN = 50.0
#: Words without any n-gram that every text is averaged with, so that one word
#: that merely resembles a toxic one does not decide a short text.
PAD = 20


class _Sum:
    """Sums rows by a fixed key: rows of one key are brought together once."""

    def __init__(self, key: np.ndarray, size: int):
        self.order = np.argsort(key, kind="stable")
        keys, self.starts = np.unique(key[self.order], return_index=True)
        self.keys, self.size = keys, size

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((self.size, rows.shape[1]), rows.dtype)
        if len(self.keys):
            out[self.keys] = np.add.reduceat(rows[self.order], self.starts, axis=0)
        return out


def bags(texts: Iterable[str | None], cache_words: int = 100_000) -> Iterator[tuple]:
    """(words, rows, times, weights) of each text: how many words it has, the
    embedding rows of their n-grams, how many words hold each, and the sum over
    these words of one in so many n-grams as the word has."""
    size, cache = 1 << BUCKET_BITS, {}
    for text in texts:
        count = Counter(tokens(text))
        if len(cache) > cache_words:
            cache.clear()
        times, weights = np.zeros(size), np.zeros(size)
        grams, held, part = [], [], 0

        def add():
            at, per = np.concatenate(grams), [len(g) for g in grams]
            times[:] += np.bincount(at, np.repeat(held, per), size)
            weights[:] += np.bincount(at, np.repeat(np.divide(held, per), per), size)

        for word, n in count.items():
            own = cache.get(word)
            if own is None:
                own = np.fromiter(gram_rows(word), np.int32)
                if len(cache) <= cache_words:
                    cache[word] = own
            grams.append(own)
            held.append(n)
            part += len(own)
            if part > 1_000_000:
                add()
                grams, held, part = [], [], 0
        if grams:
            add()
        rows = np.flatnonzero(times)
        yield count.total(), rows.astype(np.int32), times[rows].astype(np.int64), weights[rows]


class _Batch:
    """Some texts as bags of n-gram rows, and the loss's gradients over them."""

    def __init__(self, ids: list[np.ndarray], rows: list[np.ndarray], y):
        """From the words of each text, and of each distinct word, in order, how
        many n-grams it has and which of their rows learn."""
        number, own = np.unique(np.concatenate(ids)), []
        for words in ids:
            at = np.searchsorted(number, words)
            gram = np.concatenate([rows[w][1:] for w in at])
            own.append((gram, np.repeat([1 / rows[w][0] for w in at], [len(rows[w]) - 1 for w in at])))
        self._set([len(w) for w in ids], own, y)

    @classmethod
    def of_bags(cls, length: list[int], own: list[tuple[np.ndarray, np.ndarray]], y) -> _Batch:
        """From the number of words and the (rows, weights) of each text."""
        batch = cls.__new__(cls)
        batch._set(length, own, y)
        return batch

    def _set(self, length, own, y):
        self.scale = (GAIN / (np.array(length) + PAD)).astype(np.float32)[:, None]
        self.y = y
        self.rows, self.gram = np.unique(np.concatenate([r for r, _ in own]), return_inverse=True)
        self.weight = np.concatenate([w for _, w in own]).astype(np.float32)[:, None]
        self.text = np.repeat(np.arange(len(own)), [len(r) for r, _ in own])
        self.by_gram, self.by_text = _Sum(self.gram, len(self.rows)), _Sum(self.text, len(own))

    def gradients(self, emb, soft, bias):
        text_vec = self.by_text(emb[self.rows][self.gram] * self.weight) * self.scale
        logit = text_vec @ soft + bias
        p = 1 / (1 + np.exp(np.clip(logit[:, 0] - logit[:, 1], -30, 30)))
        grad = (p - self.y) / len(self.y)
        d_logit = np.stack([-grad, grad], 1).astype(np.float32)
        d_text = d_logit @ soft.T * self.scale
        d_emb = np.zeros_like(emb)
        d_emb[self.rows] = self.by_gram(d_text[self.text] * self.weight)
        return d_emb, text_vec.T @ d_logit, d_logit.sum(0)


UNIT = 2.0**40  # shares are summed as whole numbers, so that the order of texts changes nothing


def row_sums(counts: Iterable[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """(sum of each n-gram row's shares of the clean and of the toxic texts, texts
    that hold it) over (words, rows, times, label) of texts."""
    size = 1 << BUCKET_BITS
    units, held_by = np.zeros((2, size), np.int64), np.zeros(size, np.int64)
    for words, rows, times, label in counts:
        if words:
            units[int(label), rows] += (times / words * UNIT).astype(np.int64)
            held_by[rows] += 1
    return units, held_by


def _live_part(live: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that learn, counted among those that do, and their weights."""
    learn = live[rows]
    return (np.cumsum(live) - 1)[rows[learn]], weights[learn]


class SubwordModel:
    """Embedding table, softmax and their training."""

    def __init__(self, dim: int = 4, steps: int = 800, batch_texts: int = 150, rate: float = 0.02,
                 least_texts: int = 3, least_ratio: float = 2.0, seed: int = 5):
        self.dim, self.steps, self.batch_texts, self.rate = dim, steps, batch_texts, rate
        self.least_texts, self.least_ratio, self.seed = least_texts, least_ratio, seed
        self.gram_scores = np.zeros(1 << BUCKET_BITS, np.float32)
        self.bias = -30.0

    def fit(self, texts: list[str | None], labels: list[int]) -> SubwordModel:
        """Learn from whole texts."""
        own, y = list(bags(texts)), np.asarray(labels, float)
        if not 0 < y.sum() < len(y):
            return self
        units, held_by = row_sums((words, rows, times, label) for (words, rows, times, _), label in zip(
            own, labels, strict=True))
        live, ratio = self.learning_rows(units, held_by, y)
        return self.train(live, ratio, [words for words, *_ in own], [_live_part(live, b[1], b[3]) for b in own], y)

    def learning_rows(self, units: np.ndarray, held_by: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which n-gram rows learn, log ratio of their shares), from ``row_sums``.

        Only rows that at least ``least_texts`` texts hold and whose share of a
        toxic text's n-grams is e**``least_ratio`` times that of a clean one
        (smoothed) learn; the log ratio is the first dimension's start.  All
        others stay zero: with few labels they could only memorise the sample."""
        share = units / UNIT
        toxic, smooth = y.sum(), 0.005 / y.sum()
        ratio = np.log((share[1] / toxic + smooth) / (share[0] / (len(y) - toxic) + smooth)) - self.least_ratio
        return (ratio > 0) & (held_by >= self.least_texts), ratio

    def train(self, live: np.ndarray, ratio: np.ndarray, length: list[int],
              own: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> SubwordModel:
        """Train on the words of each text and the (rows, weights) that learn,
        rows counted among those that do."""
        rng = np.random.default_rng(self.seed)
        emb = rng.normal(0, 0.01, (len(live), self.dim))[live].astype(np.float32)
        emb[:, 0] = ratio[live]
        soft = rng.normal(0, 0.01, (self.dim, 2)).astype(np.float32)
        soft[0] = -0.5, 0.5
        bias = np.array([1.0, -1.0], np.float32)
        order = rng.permutation(np.flatnonzero(length))
        batches = []
        for part in np.array_split(order, max(1, round(len(order) / self.batch_texts))):
            if len(part):
                batches.append(_Batch.of_bags([length[d] for d in part], [own[d] for d in part], y[part]))
        state = [(p, np.zeros_like(p), np.zeros_like(p)) for p in (emb, soft, bias)]
        for step in range(1, self.steps + 1 if batches else 1):
            gradients = batches[step % len(batches)].gradients(emb, soft, bias)
            for (param, m, v), g in zip(state, gradients, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                param -= self.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        self.gram_scores[live] = (emb @ (soft[:, 1] - soft[:, 0])).astype(np.float32)
        self.bias = float(bias[1] - bias[0])
        return self

    def scorer(self, cache_words: int = 400_000) -> Callable[[str | None], float]:
        """A function from a text to its score, with a bounded word cache."""
        cache: dict[str, float] = {}
        rows = np.flatnonzero(self.gram_scores)
        score_of = dict(zip(rows.tolist(), self.gram_scores[rows].tolist(), strict=True))
        bias = self.bias

        def word_score(word: str) -> float:
            grams = gram_rows(word)
            return sum(score_of[g] for g in grams if g in score_of) / len(grams)

        def score(text: str | None) -> float:
            words = tokens(text)
            try:
                total = sum(map(cache.__getitem__, words))
            except KeyError:
                if len(cache) > cache_words:
                    cache.clear()
                for w in words:
                    if w not in cache:
                        cache[w] = word_score(w)
                total = sum(map(cache.__getitem__, words))
            return 1 / (1 + math.exp(min(700.0, -GAIN * total / (len(words) + PAD) - bias)))

        return score


def _fold(id_col):
    """0 to 4 by the id's checksum; 0 is held out."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = SAMPLE_ROWS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> SubwordModel:
    """Train on at most ``rows_per_class`` labelled rows of each class outside
    the held-out fold; with contrary labels for an id, the higher counts."""
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
              .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & (_fold(F.col("id")) != 0))
              .groupBy("id").agg(F.max("label").alias("label"))
              .withColumn("turn", F.xxhash64("id")))
    sample = None
    for label in (0, 1):
        part = marked.where(F.col("label") == label).orderBy("turn", "id").limit(rows_per_class)
        sample = part if sample is None else sample.unionByName(part)
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(sample), "id")  # at most twice rows_per_class rows
             .groupBy("id", "label", "turn").agg(F.max("text").alias("text")))
    # Written, as it is read twice: counts of n-gram rows, 2 ** BUCKET_BITS a text at most.
    counted = written(texts.mapInPandas(_bags_of, f"turn long, id {docs.schema[id_col].dataType.simpleString()}, "
                                        "label int, words long, rows binary, times binary, weights binary"), "toxicity-bags")
    other = F.xxhash64(F.lit(7), "id").alias("other")  # with the turn, 128 bits of a hash name a text
    rows = counted.select("turn", other, "label").collect()
    rows.sort(key=lambda r: (r["turn"], r["other"]))
    y = np.array([r["label"] for r in rows], float)
    model = SubwordModel()
    if 0 < y.sum() < len(y):
        live, ratio = model.learning_rows(*_summed(counted), y)
        # Of each text, only the rows that learn leave the tasks.
        place = {(r["turn"], r["other"]): i for i, r in enumerate(rows)}
        length, own = [0] * len(y), [(np.zeros(0, np.int64), np.zeros(0))] * len(y)

        def live_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                parts = [_live_part(live, np.frombuffer(r, np.int32), np.frombuffer(w))
                         for r, w in zip(batch["rows"], batch["weights"], strict=True)]
                yield batch.assign(rows=[p[0].tobytes() for p in parts], weights=[p[1].tobytes() for p in parts])

        for r in counted.select("turn", other, "words", "rows", "weights").mapInPandas(
                live_parts, "turn long, other long, words long, rows binary, weights binary").collect():
            i = place[r["turn"], r["other"]]
            length[i], own[i] = r["words"], (np.frombuffer(r["rows"], np.int64), np.frombuffer(r["weights"]))
        model.train(live, ratio, length, own, y)
    forget(counted)
    # The sample is even-handed where the labels are not: the bias goes back to their odds.
    n = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    taken = [sum(r["label"] == label for r in rows) for label in (0, 1)]
    if all(taken):
        model.bias += math.log(n[1] / n[0] * taken[0] / taken[1])
    return model


def _summed(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """``row_sums`` of all texts, added up in Spark: at most 2 ** BUCKET_BITS rows
    of four numbers come back, packed."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units, held_by = row_sums((words, np.frombuffer(rows, np.int32), np.frombuffer(times, np.int64), label)
                                  for batch in batches for words, rows, times, label in batch.itertuples(index=False))
        row = np.flatnonzero(held_by)
        yield pd.DataFrame({"row": row, "clean": units[0, row], "toxic": units[1, row], "held": held_by[row]})

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([[group[c].to_numpy(np.int64).tobytes() for c in columns]], columns=columns)

    columns = ["row", "clean", "toxic", "held"]
    sums = counted.select("words", "rows", "times", "label").mapInPandas(
        partial, "row long, clean long, toxic long, held long").groupBy("row").agg(
            *[F.sum(c).alias(c) for c in columns[1:]])
    units, held_by = np.zeros((2, 1 << BUCKET_BITS), np.int64), np.zeros(1 << BUCKET_BITS, np.int64)
    for r in sums.groupBy(F.floor(F.col("row") / 4096)).applyInPandas(
            packed, "row binary, clean binary, toxic binary, held binary").collect():
        row, clean, toxic, held = (np.frombuffer(r[c], np.int64) for c in columns)
        units[0, row], units[1, row], held_by[row] = clean, toxic, held
    return units, held_by


def _bags_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """turn, id, label and the bag of each text, some MB at a time."""
    columns = ["turn", "id", "label", "words", "rows", "times", "weights"]
    for batch in batches:
        out, held = [], 0
        for (turn, key, label), bag in zip(batch[columns[:3]].itertuples(index=False), bags(batch["text"]), strict=True):
            out.append((turn, key, label, bag[0], *(x.tobytes() for x in bag[1:])))
            held += 20 * len(bag[1])
            if held > 8_000_000:
                yield pd.DataFrame(out, columns=columns)
                out, held = [], 0
        yield pd.DataFrame(out, columns=columns)


def score_column(model: SubwordModel, text_col: str = "text"):
    """The score of a text column, in [0, 1]."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = model.scorer()
        for batch in batches:
            yield pd.Series([score(t) for t in batch], dtype="float64")

    return scores(F.col(text_col))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(_fold(F.col(id_col)) == 0, F.lit(False)).alias("held_out"),
        score_column(model, text_col).alias("score")).withColumn(
            "predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """The documents that score under 0.5, with all their columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"),
                       score_column(model, text_col).alias("score"))
    return rows.where("score < 0.5").select("own.*")
