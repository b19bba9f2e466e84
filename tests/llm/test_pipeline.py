from collections import Counter

import corpus_pipeline as C
from quarry.llm import hyperminhash, mixing, secret_ledger, toxicity
from quarry.llm.common import written


def test_stages_against_their_operators(spark, sf_small, docs, labels):
    names = [n for n, _ in C.STAGES]
    assert names == ["toxicity", "near_dedup", "secrets", "mix", "pack"]
    before, columns = docs, docs.columns
    kept = {}
    for name, stage in C.STAGES:
        after = written(stage(spark, before, sf_small), "stage-test")
        kept[name] = after
        if name != "pack":
            assert after.columns == columns
        before = after
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, labels).collect()}
    ids = {n: Counter(r["doc_id"] for r in df.select("doc_id").collect()) for n, df in kept.items()}
    assert set(ids["toxicity"]) == {d for d, s in scores.items() if s < 0.5}
    near = hyperminhash.near_duplicates(kept["toxicity"]).collect()
    assert ids["near_dedup"] == Counter(r["doc_id"] for r in near if r["kept"])
    assert ids["secrets"] == ids["near_dedup"]
    assert not any(secret_ledger.find_spans(r["text"] or "") for r in kept["secrets"].collect())
    mix = mixing.mix_report(kept["secrets"]).collect()
    assert ids["mix"] == Counter({r["doc_id"]: r["copies"] for r in mix if r["copies"]})
    firsts = Counter(r["doc_id"] for r in kept["pack"].where("piece = 0").collect())
    assert firsts == ids["mix"]


def test_run_gives_the_last_stage(spark, sf_small):
    out = C.run(spark, sf_small)
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_stages_on_empty_and_tricky_tables(spark, sf_small, tricky, nothing):
    for start in (nothing, tricky):
        docs = start
        for _, stage in C.STAGES:
            docs = written(stage(spark, docs, sf_small), "stage-test")
        assert docs.count() == 0 if start is nothing else docs.count() > 0
