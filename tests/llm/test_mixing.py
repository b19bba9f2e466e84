import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing as M
from tests.llm.conftest import prose


def by_source(rows):
    out = {}
    for r in rows:
        s = out.setdefault(r["source"], {"size": r["source_size"], "target": r["target"], "taken": 0, "largest": 0})
        s["taken"] += r["taken"]
        s["largest"] = max(s["largest"], r["size"])
    return out


def water_filled(sizes, weights, share=1.5, most=2):
    """Targets by raising one level until the budget is spent."""
    budget, capped = share * sum(sizes), set()
    while True:
        open_to = [i for i in range(len(sizes)) if i not in capped]
        left = budget - sum(most * sizes[i] for i in capped)
        level = left / sum(weights[i] for i in open_to) if open_to else 0
        over = {i for i in open_to if level * weights[i] > most * sizes[i]}
        if not over:
            return [most * sizes[i] if i in capped else level * weights[i] for i in range(len(sizes))]
        capped |= over


def test_targets_and_taken_words(spark):
    rows = [(i, prose(i, 20 + i % 50), ["big", "mid", "small", "é"][0 if i % 3 else i % 4]) for i in range(2000)]
    out = by_source(M.mix_report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    names = sorted(out)
    want = water_filled([out[s]["size"] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))])
    for s, t in zip(names, want, strict=True):
        assert out[s]["target"] == pytest.approx(t)
        assert abs(out[s]["taken"] - t) <= 2 * max(o["largest"] for o in out.values())


def test_reruns_and_partitioning_agree(docs):
    a = sorted(map(tuple, M.mix_report(docs).collect()))
    b = sorted(map(tuple, M.mix_report(docs.repartition(7)).collect()))
    assert a == b


def test_mixed_repeats_rows(docs):
    counts = {r["doc_id"]: r["copies"] for r in M.mix_report(docs).collect()}
    out = M.mixed(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {d: n for d, n in counts.items() if n}


def test_tricky(tricky, nothing):
    rows = M.mix_report(tricky).collect()
    assert len(rows) == tricky.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["source"] for r in rows} == {"a", "b", "c", None}
    assert M.mixed(tricky).columns == tricky.columns
    assert M.mix_report(nothing).collect() == [] and M.mixed(nothing).collect() == []


def test_hot_source_and_no_words(spark):
    rows = [(i, "" if i % 5 == 0 else prose(i, 30), "hot" if i % 3 else f"s{i % 12}") for i in range(900)]
    rows += [(1000 + i, " ", "silent") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = by_source(M.mix_report(df, weights=(1, 5)).collect())
    assert out["silent"]["target"] == 0 and out["silent"]["taken"] == 0
    total = sum(o["size"] for o in out.values())
    assert abs(sum(o["taken"] for o in out.values()) - 1.5 * total) <= 60


def test_extra_columns_named_like_internals(spark):
    df = spark.createDataFrame([(1, "a b c", "x")], "doc_id long, text string, source string")
    df = df.withColumn("cut_source", F.lit("x")).withColumn("cut_id", F.lit(1)).withColumn("source_no", F.lit(2))
    assert M.mixed(df).columns == df.columns
