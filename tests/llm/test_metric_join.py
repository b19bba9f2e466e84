import numpy as np
import pytest

from quarry.llm import metric_join as M

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(seed=0, n=400, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (25, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(25)] + rng.normal(0, 0.17, dim)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(3))))
    return rows


def brute(rows, least=0.93):
    ids = [r[0] for r in rows]
    links = {i: set() for i in ids}
    for i, a, la in rows:
        for j, b, lb in rows:
            if i != j and la == lb and la is not None and a is not None and b is not None and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                    links[i].add(j)
    comp = {}
    for i in sorted(ids):
        if i not in comp:
            stack = [i]
            while stack:
                k = stack.pop()
                if k not in comp:
                    comp[k] = i
                    stack += links[k]
    return {i: (len(links[i]), comp[i]) for i in ids}


@pytest.mark.parametrize("options", [{}, {"cell_size": 12}, {"cell_size": 12, "block": 5}, {"block": 17}])
def test_against_all_pairs(spark, options):
    rows = clustered()
    out = M.range_join(spark.createDataFrame(rows, SCHEMA), **options).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out} == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def test_copies_are_counted_and_scale_does_not_matter(spark):
    base = clustered(3, 60)
    rows = base + [(1000 + i, base[0][1], base[0][2]) for i in range(40)]
    rows += [(2000 + i, [x * 4 for x in base[1][1]], base[1][2]) for i in range(5)]
    out = M.range_join(spark.createDataFrame(rows, SCHEMA), cell_size=9).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out} == brute(rows)


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
           (7, [1.0, 1.0], None), (8, [1.0, 1.0], None), (9, [1.0, 1.0, 1.0], 1), (None, [1.0, 1.0], 1)]
    fine = [(20, [1.0, 1.0], 1), (21, [1.0, 1.01], 1), (22, [1.0, 1.0], 2), (23, [1e-30, 1e-30], 2), (23, [1e-30, 1e-30], 2)]
    df = spark.createDataFrame(odd + fine, SCHEMA).selectExpr("*", "1 as cell", "2 as rep", "3 as home", "4 as n", "5 as usable")
    out = M.range_join(df).collect()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out}
    assert len(out) == len(odd + fine)
    assert all(got[i] == (0, i, True) for i in range(1, 10)) and got[None] == (0, None, True)
    assert got[20] == (1, 20, True) and got[21] == (1, 20, False)
    assert got[22] == (1, 22, True) and got[23] == (1, 22, False)
    assert M.range_join(df.limit(0)).collect() == []


def test_tight_clusters_are_hardly_replicated(spark):
    """The triangle inequality keeps far cells apart where the data has structure."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        v = np.zeros(32)
        v[i % 30] = 10
        rows.append((i, [float(x) for x in (v + rng.normal(0, 0.05, 32)).astype(np.float32)], 0))
    out = M.range_join(spark.createDataFrame(rows, SCHEMA), cell_size=20).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out} == {i: (19, i % 30) for i in range(600)}


def test_vectors_without_structure_become_one_grid(spark, monkeypatch):
    """Cut into cells, each would be copied to nearly all; the clustered label stays cut."""
    monkeypatch.setattr(M, "FEW_COPIES", 9)
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 24).astype(np.float32)], 0) for i in range(300)]
    centre = np.eye(24)[rng.integers(0, 4, 300)] * 9 + rng.normal(0, 0.1, (300, 24))
    rows += [(1000 + i, [float(x) for x in v.astype(np.float32)], 1) for i, v in enumerate(centre)]
    kept = []
    plain = M._worth_cutting
    monkeypatch.setattr(M, "_worth_cutting", lambda *a: kept.append(plain(*a)) or kept[-1])
    out = M.range_join(spark.createDataFrame(rows, SCHEMA), cell_size=15, block=100).collect()
    assert kept == [{(1, 24)}]
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out} == brute(rows)


def test_blocks_hold_bounded_bytes():
    assert M._block_rows(64) * 64 * 8 <= M.BLOCK_BYTES and M._block_rows(10**6) == 1024
