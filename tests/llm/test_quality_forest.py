import re
from collections import Counter

import numpy as np

from quarry.llm import quality_forest as Q
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


TEXTS = ["", None, " \n\t ", "a", "a a a", "a a a a", "x y z x y z", "one\ntwo\none\n\n \none ", "É日 本#$ \x85 <|>",
         "a\rb\x0bc\x0cd", "same line\nsame line\nsame line", prose(1, 500) + " " + prose(1, 40), " a b c"]


def test_base_statistics_against_brute_force(docs):
    for t in TEXTS + [r["text"] for r in docs.collect()]:
        assert tuple(Q.measure(t)[:5]) == brute(t)


def labelled(spark):
    good = [(i, prose(i, 60 + i % 200), 1) for i in range(200)]
    bad = [(1000 + i, " ".join(w + "###" for w in prose(i, 100).split()), 0) for i in range(30)]
    bad += [(2000 + i, prose(i, 100).upper() + "!!", 0) for i in range(30)]
    bad += [(3000 + i, "buy now " * 60, 0) for i in range(10)]
    rows = good + bad
    return (spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"),
            spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int"), rows)


def test_clean_texts_are_kept_and_junk_goes(spark):
    docs, labels, rows = labelled(spark)
    out = {r["doc_id"]: r for r in Q.judge(docs, labels).collect()}
    assert np.mean([out[i]["kept"] for i, _, q in rows if q]) >= 0.98
    assert np.mean([out[i]["kept"] for i, _, q in rows if not q]) <= 0.05
    assert all(out[i]["base_failed"] for i in range(3000, 3010))


def test_anomalies_on_the_low_side_go(spark):
    docs, labels, rows = labelled(spark)
    odd = spark.createDataFrame([(9000, " ".join(chr(0x100 + i) for i in range(200)))], docs.schema)
    out = {r["doc_id"]: r["kept"] for r in Q.judge(docs.unionByName(odd), labels).collect()}
    assert not out[9000] and np.mean([out[i] for i, _, q in rows if q]) >= 0.98


def test_bad_rows_that_all_fail_the_base_rules(spark):
    docs, labels, rows = labelled(spark)
    out = {r["doc_id"]: r["kept"] for r in Q.judge(docs, labels.where("quality = 1 or doc_id >= 3000")).collect()}
    assert np.mean([out[i] for i, _, q in rows if q]) >= 0.98
    assert np.mean([out[i] for i, _, q in rows if not q]) <= 0.5


def test_sample_data_held_out(spark, sf_large):
    docs, labels = (spark.read.parquet(f"{sf_large}/{t}.parquet") for t in ("documents", "labels"))
    rows = [r for r in Q.judge(docs, labels).join(labels, "doc_id").where(
        "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").collect()]
    assert np.mean([r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]) >= 0.98
    assert np.mean([r["kept"] for r in rows if r["quality"] == 0]) <= 0.05


def test_isolated_points_have_short_paths():
    rng = np.random.default_rng(2)
    points = np.r_[rng.normal(0, 1, (500, 3)), [[9, 9, 9]]]
    scores = Q.Forest.grow(points, np.full(3, -100.0)).scores(points)
    assert scores[-1] > np.quantile(scores[:-1], 0.99)


def test_tricky(spark, tricky, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 1), (7, 0), (None, 1), (9, None), (12, 1), (13, 0), (13, 1)],
                                   "doc_id long, quality int")
    for marked in (labels, labels.limit(0)):
        rows = Q.judge(tricky, marked).collect()
        assert len(rows) == tricky.count()
        for r in rows:
            assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])
            assert not (r["base_failed"] and r["kept"])
    assert Q.judge(nothing, labels).collect() == []
