import zlib

from quarry.llm.sharding import shard_by_bytes


def check(rows, n_in, shards):
    assert len(rows) == n_in
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for s in range(shards):
        own = by.get(s, [])
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / shards) <= largest
    # contiguous: starts rise from shard to shard
    for s in range(1, shards):
        if s in by and s - 1 in by:
            assert max(r["start_byte"] for r in by[s - 1]) < min(r["start_byte"] for r in by[s])


def test_balanced_and_gapless(spark, docs):
    rows = shard_by_bytes(docs, 16, blocks=5).collect()
    check(rows, docs.count(), 16)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)


def test_blocks_do_not_change_the_result(docs):
    a, b = (sorted((r["doc_id"], r["shard"], r["slot"]) for r in shard_by_bytes(docs, 7, blocks=n).collect())
            for n in (1, 9))
    assert a == b


def test_tricky(tricky, nothing):
    check(shard_by_bytes(tricky, 3, blocks=4).collect(), tricky.count(), 3)
    assert shard_by_bytes(nothing, 4).collect() == []


def test_one_text_in_a_third_of_the_rows_is_split(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    out = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 16, blocks=8).collect()
    check(out, 3000, 16)
    assert len({r["shard"] for r in out if r["doc_id"] % 3 == 0}) >= 5


def test_no_python_in_the_plan(docs, capsys):
    shard_by_bytes(docs, 4).explain()
    assert "Python" not in capsys.readouterr().out
