import re

from quarry.llm import common
from quarry.llm import secret_ledger as S
from quarry.llm.common import scratch

LOOSE = {"assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                              re.I | re.A),
         "access": re.compile(r"AKIA[A-Z0-9]+"), "hex": re.compile(r"[0-9a-f]+")}


def brute(text):
    out = [("assign", m.start(), m.end()) for m in LOOSE["assign"].finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in LOOSE["access"].finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in LOOSE["hex"].finditer(text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


CASES = ["", "password=short", "Password = 'abcdef'", "token=key=secret=abcdefg", "AKIA" + "A" * 15, "AKIA" + "A" * 16,
         "AKIAAKIA" + "B" * 20, "x" + "0123456789abcdef" * 2 + "g", "0" * 23, "0" * 24, "api_key: \"zz.zz-zz\" APIKEY=abcdef",
         "paſſword=abcdef toKen=abcdef", "password=token:abcdefgh", "é日 secret:  " + "ab" * 20,
         "password = " + "deadbeef" * 4]


def test_spans_against_the_plain_patterns(docs):
    for t in CASES + [r["text"] or "" for r in docs.collect()]:
        assert S.find_spans(t) == brute(t)


def test_every_path_gets_its_blobs_findings(spark, tricky, nothing):
    rows = S.scan(tricky).collect()
    assert len(rows) == tricky.count()
    text = {r["doc_id"]: r["text"] or "" for r in tricky.collect()}
    for r in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in r["spans"] or []] == brute(text[r["doc_id"]])
    assert S.scan(nothing).collect() == []


def test_ledger_scans_only_unseen_pairs(spark):
    path = scratch(spark, "ledger-test")
    first = spark.createDataFrame([(1, "token=abcdef1"), (2, "token=abcdef1"), (3, None)], "doc_id long, text string")
    then = spark.createDataFrame([(1, "token=abcdef1"), (9, "secret=abcdef2"), (9, "clean")], "doc_id long, text string")
    ledger = S.Ledger(spark, path)
    S.scan(first, path).count()
    assert ledger.scanned().count() == 2 and ledger.findings().count() == 1
    out = S.scan(then, path).collect()
    assert ledger.scanned().count() == 4 and ledger.findings().count() == 2
    assert sorted((r["doc_id"], len(r["spans"] or [])) for r in out) == [(1, 1), (9, 0), (9, 1)]
    S.scan(then, path, rules="base-2").count()
    assert ledger.scanned().where("rules = 'base-2'").count() == 3


def test_a_scan_that_died_before_marking_counts_once(spark):
    path = scratch(spark, "ledger-test")
    docs = spark.createDataFrame([(1, "token=abcdef1")], "doc_id long, text string")
    S.scan(docs, path).count()
    ledger = S.Ledger(spark, path)
    ledger.findings().write.mode("append").parquet(f"{path}/again")
    spark.read.parquet(f"{path}/again").write.mode("append").parquet(f"{path}/findings")
    assert [len(r["spans"]) for r in S.scan(docs, path).collect()] == [1]


def test_redacted(tricky, nothing):
    out = S.redacted(tricky, marker="***")
    assert out.columns == tricky.columns
    rows, text = out.collect(), {r["doc_id"]: r["text"] for r in tricky.collect()}
    assert len(rows) == len(tricky.collect())
    for r in rows:
        old = text[r["doc_id"]]
        if r["doc_id"] == 10:
            assert r["text"] == "É日本 ñ 😀 *** *** ***" and r["n_chars"] == len(r["text"])
        else:
            assert r["text"] == old
    assert S.redacted(nothing).count() == 0


def test_few_blobs_with_many_spans_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "SMALL_ROWS", 3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for spans, broadcast in ((1, True), (3, False)):
            df = spark.createDataFrame([(i, f"{i} " + " ".join(["0a" * 14] * spans)) for i in range(2)],
                                       "doc_id long, text string")
            out = S.redacted(df)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) == broadcast
            assert sorted(r["text"] for r in out.collect()) == [f"{i} " + " ".join(["[secret]"] * spans) for i in range(2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_each_blob_is_scanned_once_whatever_its_rows(spark):
    rows = [(1, "token=abcdef1")] * 5 + [(None, "token=abcdef1")] * 4 + [(2, "x")] * 3 + [(None, None), (3, ""), (4, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ledger = S.Ledger(spark, scratch(spark, "ledger-test"))
    texts = S._with_blob(docs, "doc_id", "text")
    assert sorted(r["text"] for r in ledger.unseen(texts).collect()) == ["", "token=abcdef1", "x", "y"]
    ledger.update(texts.where("text in ('x', 'y')"))
    assert sorted(r["text"] for r in ledger.unseen(texts).collect()) == ["", "token=abcdef1"]
    out = S.scan(docs, ledger.path).collect()
    assert len(out) == len(rows) and sum(len(r["spans"] or []) for r in out) == 9
    assert ledger.scanned().count() == 4


def test_copies_meet_findings_over_plain_exchanges(spark, monkeypatch):
    monkeypatch.setattr(common, "SMALL_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(1, "token=abcdef1")], "doc_id long, text string")
        plan = S.scan(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Aggregate" not in plan
