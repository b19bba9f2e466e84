import random
import re

import numpy as np
import pytest

from quarry.llm import hyperminhash as H
from quarry.llm.graph import components
from quarry.llm.shingles import Shingler, jaccard_parts
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(rows):
    out = {}
    for doc_id, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = WORD.findall(lowered)
        out[doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return out


def brute(rows):
    sets = brute_sets(rows)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_copy(text, seed, changes):
    rng, w = random.Random(seed), text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def planted():
    rows = [(i, prose(i, 150)) for i in range(40)]
    base = prose(999, 200)
    rows += [(100 + i, near_copy(base, i, 4)) for i in range(60)]       # a group of near copies
    rows += [(200 + i, rows[3][1].upper()) for i in range(5)]           # copies in other case
    rows += [(300 + i, near_copy(rows[i][1], i, i % 9)) for i in range(30)]
    rows += [(400, "few words"), (401, "Few  words"), (402, "few words more"), (403, ""), (404, None), (405, "   ")]
    return rows


@pytest.mark.parametrize("blocks", [{}, {"block_classes": 7}])
def test_against_brute_force(spark, blocks):
    rows = planted()
    out = H.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **blocks).collect()
    want = brute(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_chain_of_near_copies_is_one_component(spark):
    text, rows = prose(5, 400), []
    for i in range(25):
        rows.append((i, text))
        text = near_copy(text, 1000 + i, 5)
    out = H.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block_classes=6).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == {d: c for d, (_, c) in brute(rows).items()}


def brute_versions(rows):
    """(doc_id, n_shingles, component_id) of rows whose ids may repeat; no null ids."""
    texts = brute([(i, t) for i, (_, t) in enumerate(rows)])
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (d, _) in enumerate(rows):
        if texts[i][0]:
            p, q = find(d), find(rows[texts[i][1]][0])
            root[max(p, q)] = min(p, q)
    return sorted((d, texts[i][0], find(d) if texts[i][0] else d) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("blocks", [{}, {"block_classes": 7}])
def test_one_id_with_several_texts(spark, blocks):
    a, b, c = prose(1, 150), prose(2, 150), prose(3, 150)
    rows = [(5, a), (5, b), (9, near_copy(b, 1, 3)), (12, near_copy(a, 2, 3)), (13, b), (14, near_copy(b, 3, 3)),
            (5, b), (21, c), (20, prose(4, 90)), (20, c), (3, prose(6, 90)), (3, prose(7, 90)), (30, prose(7, 90)),
            (40, prose(8, 90)), (40, ""), (41, prose(9, 90))]
    base = prose(50, 200)
    rows += [(100, near_copy(base, i, 4)) for i in range(15)] + [(101 + i, near_copy(base, 50 + i, 4)) for i in range(15)]
    rows += [(200, prose(60 + i, 90)) for i in range(10)] + [(201 + i, near_copy(prose(60 + i, 90), i, 2)) for i in range(10)]
    out = H.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **blocks).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == brute_versions(rows)


def test_estimates_follow_the_jaccard_index():
    shingle, errors = Shingler(), []
    for i in range(60):
        a = prose(i, 300)
        x, y = shingle(a), shingle(near_copy(a, i, i // 2))
        inter, union = jaccard_parts(x, y)
        share = np.array([(H.registers(x) == H.registers(y)).mean()])
        errors.append(H.estimate(share, np.array([len(x)]), np.array([len(y)]))[0] - inter / union)
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.15


def test_registers_hold_zeros_and_mantissa():
    shingle = Shingler()
    one = H.registers(shingle("a b c d e"))
    assert one.shape == (H.REGISTERS,) and len(set(one.tolist())) == 1  # all borrow from the one bucket
    many = H.registers(shingle(prose(1, 20_000)))
    zeros = many >> H.MANTISSA
    assert 5 < np.median(zeros) < 9  # some 100 values a bucket


def test_tricky(tricky, nothing):
    rows = H.near_duplicates(tricky).collect()
    assert len(rows) == tricky.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["component_id"] == 1 and by[8]["component_id"] == 7
    assert all(by[d]["n_shingles"] == 0 and by[d]["component_id"] == d for d in (3, 4, 5))
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert by[6]["n_shingles"] == 1 and sum(r["doc_id"] == 11 for r in rows) == 2
    assert H.near_duplicates(nothing).collect() == []


def test_deduplicated_keeps_one_of_each(tricky, nothing):
    out = H.deduplicated(tricky)
    assert out.columns == tricky.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(ids, key=str) == sorted([1, 3, 4, 5, 6, 7, None, 9, 10, 11, 12, 13, *range(20, 40)], key=str)
    assert H.deduplicated(nothing).count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(500, 560)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    df = spark.createDataFrame([*links, (None, 3), (7, 7)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
