import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import mtree as M


def by_hand(rows, k=10, step=100):
    """All scores, sorted: query_id, rank, vec_id, score."""
    known = {(i, tuple(math.floor(1024 * float(x)) for x in v)) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in known:
        if q % step == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in known if i != q and len(a) == len(b))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def clusters(n, dim=8, groups=12, spread=0.02, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, dim))
    x = middle[rng.integers(0, groups, n)] + rng.normal(0, spread, (n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, x, ids=None):
    return spark.createDataFrame([(int(i), list(map(float, v))) for i, v in zip(ids if ids is not None else range(len(x)), x)],
                                 "vec_id long, embedding array<float>").withColumn("rank", F.lit("x")).withColumn(
                                     "score", F.lit("y")).repartition(5)


def tenth(vec_id):
    return vec_id % 10 == 0


@pytest.mark.parametrize("shape", ["clusters", "noise", "lengths", "one point"])
def test_against_all_scores(spark, shape):
    rng = np.random.default_rng(4)
    x = {"clusters": lambda: clusters(900), "noise": lambda: rng.normal(size=(900, 8)),
         "lengths": lambda: rng.normal(size=(900, 3)) * rng.lognormal(0, 1.5, (900, 1)),
         "one point": lambda: np.tile(rng.normal(size=(1, 4)), (900, 1)) * (1 + (np.arange(900) % 3 == 0))[:, None]}[shape]()
    df = frame(spark, x)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = found(M.top_k(df, tenth, region_rows=60, max_regions=16, block_bytes=1200, page_rows=7))
    assert got == by_hand(rows, step=10)
    assert got == found(M.top_k(df, tenth))  # one region, one block


def test_rounds_and_query_slices(spark):
    df = frame(spark, clusters(600, groups=30, seed=2))
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    distinct = df.select("vec_id", M._whole(F.col("embedding"), 1024).alias("v")).withColumn(
        "k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(7), "v")).withColumn("dim", F.size("v"))
    tree = M.Tree(distinct, 10, region_rows=30, max_regions=20, block_bytes=1 << 20, page_rows=8)
    queries = distinct.where("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id")
    for rounds in ((), (1,), (2, 3), (1, 1, 1, 1)):
        best = tree.search(queries, rounds=rounds, query_slice=3)
        assert found(best) == by_hand(rows, step=10)


def test_tricky(spark):
    v = [0.5, -0.25, 1.0]
    odd = [(None, v), (1, None), (2, []), (3, [0.1, None, 0.2]), (4, [float("nan"), 1.0, 1.0]), (5, [1.0, float("inf"), 0.0]),
           (6, [0.0, 0.0, 0.0]), (100, [0.0, 0.0, 0.0]), (200, None), (300, [1.0, 2.0]), (7, [2.0, 1.0]), (400, [9.0]),
           (500, v), (500, v), (500, [-1.0, 0.3, 0.2]), (8, v), (8, v), (8, v)]
    rows = odd + [(1000 + 50 * i, v) for i in range(40)] + [(9, [0.4, 0.1, 0.3]), (-100, [0.3, 0.3, 0.3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    keep = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = by_hand(keep)
    assert found(M.top_k(df, lambda i: i % 100 == 0)) == want
    assert found(M.top_k(df, lambda i: i % 100 == 0, region_rows=4, max_regions=8, page_rows=2)) == want
    assert not any(q == i for q, _, i, _ in want) and {q for q, *_ in want} >= {100, 300, 500, 1000, -100}
    assert M.top_k(df.limit(0), lambda i: i % 100 == 0).collect() == []
    assert M.top_k(df.where("vec_id = 9"), lambda i: i % 100 == 0).collect() == []


def test_components_too_large_are_an_error(spark):
    df = spark.createDataFrame([(100, [1e9, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="scaled component"):
        M.top_k(df, lambda i: i % 100 == 0).collect()


def test_bounds_avoid_most_computations():
    x = np.floor(1024 * clusters(8000, dim=32, groups=80, spread=0.01)).astype(np.int64)
    largest = int((x * x).sum(1).max())
    points, region = M.Points(x, largest), M.Points(x[:1], largest)
    pages = M.build_pages(np.arange(len(x)), points, region, 100)
    assert sorted(np.concatenate([p.ids for p in pages]).tolist()) == list(range(len(x)))
    for p in pages:  # radius, parent and entry distances are what they say
        d = M.Points(p.vectors, largest).distances(p.centre)[:, 0]
        assert np.allclose(d, p.distance, atol=1e-3) and (np.diff(p.distance) >= 0).all()
        assert p.radius >= d.max() - 1e-3 and math.isclose(p.parent, p.centre.distances(region)[0, 0])
    spent = 0
    for own in range(0, 8000, 400):
        to = float(M.Points(x[own][None], None).distances(region)[0, 0])
        best, computed = M.search_block(pages, x[own], own, to, 10, largest, None)
        score = M.dots(x[own][None], x)[0]
        score[own] = -2**62
        order = np.lexsort((np.arange(len(x)), -score))[:10]
        assert best.ids.tolist() == order.tolist() and best.score.tolist() == score[order].tolist()
        spent += computed
    assert spent < 0.5 * 20 * len(x)


def test_exact_products_of_large_numbers():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-M.LARGEST + 1, M.LARGEST, (4, 100)), rng.integers(-M.LARGEST + 1, M.LARGEST, (5, 100))
    want = [[sum(int(x) * int(y) for x, y in zip(u, w)) for w in b] for u in a]
    assert M.dots(a, b).tolist() == want
