import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import resampling as R
from quarry.llm.common import written

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features_of(text):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def by_hand(docs, target, percent=5, least_words=20):
    """doc_id, n_features, weight, score, rank by the definition, all in memory."""
    bags = [Counter(c % 10_000 for c in features_of(t)) for _, t in docs]
    corpus, wanted = sum(bags, Counter()), Counter(c % 10_000 for t in target for c in features_of(t))
    s_all, t_all = corpus.total() + 10_000, wanted.total() + 10_000
    gain = [math.floor(1000 * math.log(float(wanted[b] + 1) * s_all / (float(corpus[b] + 1) * t_all)))
            for b in range(10_000)]
    rows = []
    for (i, text), bag in zip(docs, bags, strict=True):
        weight = sum(n * gain[b] for b, n in bag.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, bag.total(), weight, weight + noise, None, len(words_of(text))])
    able = sorted((r for r in rows if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def drawn(df):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("chunk", [1 << 18, 300, 7])
def test_checksums_of_all_runs(monkeypatch, chunk):
    monkeypatch.setattr(R, "CHUNK", chunk)
    rng = random.Random(1)
    parts = ["the", "Cat", " ", ", ", " ", "\n", "1", "É日本", "ß", "x" * 63, "x" * 64, "x" * 65, "y" * 5000, "A" * 8191]

    def text():
        return "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 5, 40, 200])))

    for _ in range(6):
        texts = [text() for _ in range(15)] + [None, ""]
        column = pa.array(["before", *texts, "after"])[1:-1]
        got = [[] for _ in texts]
        for first, words, known in R._spans(*R._texts(column)):
            for at, crc in words.features(known):
                for a, c in zip(at.tolist(), crc.tolist(), strict=True):
                    got[first + a].append(c)
        assert list(map(sorted, got)) == [sorted(features_of(t)) for t in texts]


def test_advance_by_any_length():
    rng = random.Random(2)
    for n in (0, 1, 63, 64, 65, 4095, 4096, 100_000):
        a, b = rng.randbytes(20), rng.randbytes(n)
        out = R.advance(np.array([zlib.crc32(a)], np.uint32), np.array([n]))
        assert int(out[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_whole_tables_against_brute_force(spark, docs, sf_small):
    target = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    got = drawn(R.resample(docs, target))
    assert got == by_hand([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    assert sum(r[4] is not None for r in got) > 0


def test_tricky(spark, tricky, nothing):
    target = spark.createDataFrame([("river stone table music",), (None,), ("",)], "text string")
    texts = [(r["doc_id"], r["text"]) for r in tricky.collect()]
    for percent in (0, 5, 30, 100):
        want = by_hand(texts, [r["text"] for r in target.collect()], percent)
        assert drawn(R.resample(tricky, target, percent=percent)) == want
    assert R.resample(nothing, target).collect() == []
    none = drawn(R.resample(tricky, target.limit(0), percent=30))
    assert none == by_hand(texts, [], 30)
    assert all(r[4] is None for r in drawn(R.resample(tricky.where("doc_id = 6"), target, percent=100)))


@pytest.mark.parametrize("k", [1, 7, 100, 600, 900, 999, 1000])
def test_ties_and_repeats_at_the_cutoff(spark, k):
    # A score that nine tenths of the rows have, ids null and repeated, rows not eligible.
    rng = random.Random(k)
    rows = [(i, 5 if i % 10 else rng.randrange(-50, 60), True) for i in range(900)]
    rows += [(None, 5, True)] * 50 + [(3, 5, True)] * 50 + [(i, 99, False) for i in range(30)]
    scored = written(spark.createDataFrame(rows, "doc_id long, score long, eligible boolean").repartition(7), "scored")
    out = [(r["doc_id"], r["score"], r["rank"]) for r in R.draw(scored, k).collect()]
    ranked = sorted((r for r in out if r[2]), key=lambda r: r[2])
    able = sorted(((-s, i is None, i or 0) for i, s, ok in rows if ok))
    assert [(-s, i is None, i or 0) for i, s, _ in ranked] == able[:k]
    assert [r[2] for r in ranked] == list(range(1, k + 1))
    assert Counter((i, s) for i, s, _ in out) == Counter((i, s) for i, s, _ in rows)


def test_bisection_of_wide_ranges(spark):
    values = [-2**62, -5, 0, 0, 3, 2**40, 2**62]
    rows = spark.createDataFrame([(v,) for v in values], "x long")
    for least in range(1, len(values) + 1):
        assert R.bisect(rows, "x", least) == sorted(values, reverse=True)[least - 1]


def test_ranks_do_not_depend_on_partitions(spark, docs, sf_small):
    target = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    one = drawn(R.resample(docs.coalesce(1), target))
    assert drawn(R.resample(docs.repartition(13, F.rand(1)), target)) == one
