import random
import zlib

import pytest

from quarry.llm import toxicity as T
from tests.llm.conftest import prose

BAD = ["idiot", "scumbag", "worthless", "pathetic"]


def toxic(seed, n, misspell=False):
    rng, words = random.Random(seed), prose(seed, n).split()
    for _ in range(max(2, n // 25)):
        w = rng.choice(BAD)
        if misspell:
            at = rng.randrange(2, len(w) - 1)
            w = rng.choice([w[:at] + w[at] + w[at:], w[:at] + w[at + 1:]])
        words[rng.randrange(n)] = w
    return " ".join(words)


def corpus(misspell=False, start=0):
    rows = [(start + i, prose(start + i, 30 + i % 200), 0) for i in range(300)]
    return rows + [(start + 300 + i, toxic(start + i, 30 + i % 200, misspell), 1) for i in range(80)]


@pytest.fixture(scope="module")
def model():
    rows = corpus()
    return T.SubwordModel().fit([r[1] for r in rows], [r[2] for r in rows])


def test_unseen_texts_and_misspellings(model):
    score = model.scorer()
    for misspell, least in ((False, 0.97), (True, 0.8)):
        rows = corpus(misspell, 5000)
        hit = [score(t) >= 0.5 for _, t, y in rows if y]
        false = [score(t) >= 0.5 for _, t, y in rows if not y]
        assert sum(hit) / len(hit) >= least and sum(false) / len(false) <= 0.02


def test_a_toxic_share_counts_in_long_texts(model):
    score = model.scorer()
    assert score(toxic(1, 4000)) >= 0.5 > score(prose(2, 4000))


def test_gradients_against_differences():
    import numpy as np

    rng = np.random.default_rng(1)
    ids = [np.array([0, 1, 1, 2], np.int32), np.array([2, 3], np.int32)]
    rows = [np.array([3, 1, 4]), np.array([2, 0, 1, 5]), np.array([2, 5]), np.array([1, 2, 3])]
    batch = T._Batch(ids, rows, np.array([1.0, 0.0]))
    emb, soft, bias = rng.normal(0, .1, (6, 3)), rng.normal(0, .1, (3, 2)), rng.normal(0, .1, 2)

    def loss():
        vec = np.zeros((2, 3))
        for d, words in enumerate(ids):
            for w in words:
                vec[d] += sum(emb[g] for g in rows[w][1:]) / rows[w][0] / (len(words) + T.PAD)
        z = T.GAIN * vec @ soft + bias
        p = 1 / (1 + np.exp(z[:, 0] - z[:, 1]))
        return -(np.log(p[0]) + np.log(1 - p[1])) / 2

    for param, grad in zip((emb, soft, bias), batch.gradients(emb, soft, bias), strict=True):
        for at in np.ndindex(param.shape):
            keep, step = param[at], 1e-5
            param[at] = keep + step
            up = loss()
            param[at] = keep - step
            assert grad[at] == pytest.approx((up - loss()) / 2 / step, abs=2e-3)
            param[at] = keep


def test_documents_and_held_out_fold(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1 - r[2] if zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[2])
                                    for r in rows], "doc_id long, toxic int")
    # Contrary labels in the held-out fold must not matter.
    out = {r["doc_id"]: r for r in T.score_documents(docs, labels).collect()}
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    assert sum(out[i]["predicted"] == y for i, _, y in rows) >= 0.97 * len(rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in out.values())


def test_sample_data_held_out(spark, sf_large):
    docs, labels = (spark.read.parquet(f"{sf_large}/{t}.parquet") for t in ("documents", "labels"))
    rows = T.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows) / len(rows)
    found = [r["predicted"] for r in rows if r["toxic"] == 1]
    assert right >= 0.96 and sum(found) / len(found) >= 0.8


def test_tricky(spark, tricky, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (7, 0), (None, 1), (9, None), (12, 1), (13, 0), (13, 1)],
                                   "doc_id long, toxic int")
    rows = T.score_documents(tricky, labels).collect()
    assert len(rows) == tricky.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert T.without_toxic(tricky, labels).columns == tricky.columns
    assert T.score_documents(nothing, labels).collect() == []
    none = T.score_documents(tricky, labels.limit(0)).collect()
    assert all(r["predicted"] == 0 for r in none)


def test_bags_against_plain_counts():
    for text in (prose(1, 300) + " " + prose(1, 40), "", None, "a a é日本 <b> ..."):
        (words, rows, times, weights), = T.bags([text])
        want, share = {}, {}
        for w in T.tokens(text):
            for g in T.gram_rows(w):
                want[g] = want.get(g, 0) + 1
                share[g] = share.get(g, 0) + 1 / len(T.gram_rows(w))
        assert words == len(T.tokens(text)) and dict(zip(rows.tolist(), times.tolist())) == want
        assert dict(zip(rows.tolist(), weights.tolist())) == pytest.approx(share)


def test_no_text_goes_to_the_driver(spark, monkeypatch):
    rows, taken = corpus(), []
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    for name in ("collect", "toLocalIterator"):
        def seen(self, *a, plain=getattr(type(docs), name), **b):
            taken.extend(self.dtypes)
            return plain(self, *a, **b)
        monkeypatch.setattr(type(docs), name, seen)
    assert T.fit(docs, labels).gram_scores.any()
    assert taken and "string" not in {kind for _, kind in taken}
