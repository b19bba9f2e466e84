import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import fill_middle as M


def by_hand(doc_id, text):
    """The rule read literally, over the list of all tokens."""
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(tokens), "plain", None, None, text
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 20:
        return len(tokens), "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return len(tokens), "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


@pytest.mark.parametrize("alphabet, kind", [(["abcdefgh" * 5 + " "], "ArrayContainer"), ("1 .é日", "RunContainer"),
                                            ("ab1", "BitmapContainer")])
def test_select_against_all_ends(alphabet, kind):
    rng = random.Random(3)
    text = "".join(rng.choice(alphabet) for _ in range(3 * M.CHUNK + 17))[:3 * M.CHUNK + 17]
    ends = M.token_ends(text)
    assert [type(c).__name__ for _, c in ends.containers[:3]] == [kind] * 3
    want = [m.end() - 1 for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text, re.S)]
    assert len(ends) == len(want)
    for k in [0, 1, len(want) - 1, *(rng.randrange(len(want)) for _ in range(500))]:
        assert ends.select(k) == want[k]
    for k in (-1, len(want)):
        with pytest.raises(IndexError):
            ends.select(k)


def test_a_chunk_without_ends_and_a_full_one():
    ends = M.token_ends("a" * (2 * M.CHUNK) + " " * M.CHUNK)  # one letter run, then only ends
    assert len(ends) == 1 + M.CHUNK and [at for at, _ in ends.containers] == [M.CHUNK, 2 * M.CHUNK]
    assert ends.select(0) == 2 * M.CHUNK - 1 and ends.select(M.CHUNK) == 3 * M.CHUNK - 1


def test_letters_are_ascii_only():
    for c in map(chr, [*range(0x300), 0x212A, 0x1F600, 0xFF21, 0x10041]):
        assert len(M.token_ends("a" + c + "b")) == len(re.findall(r"[A-Za-z]+|[^A-Za-z]", "a" + c + "b", re.S)), hex(ord(c))


def test_tricky_and_markers(spark, tricky, nothing):
    extra = [(100 + i, t) for i, t in enumerate(["<P>", "a <S> b", "x<M", "<P", "<<P<S", "a<", "\n", "\x00 a\r\nb", "<", "S>x<"])]
    extra += [(200 + i, "one <" + "two P> <S three" * (i % 5)) for i in range(60)]
    docs = tricky.select("doc_id", "text", "lang", F.lit(1).alias("output"), F.lit(2).alias("form")).unionByName(
        spark.createDataFrame(extra, "doc_id long, text string").selectExpr("doc_id", "text", "'en' lang", "1 output", "2 form"))
    rows = M.fill_in_middle(docs).withColumn("back", M.restored()).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"])
                  for r in rows), key=repr)
    assert got == sorted(((i, *by_hand(i, t), t or "") for i, t in texts), key=repr)
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    assert M.fill_in_middle(nothing).collect() == []


def test_large_ids_beside_null_keep_their_value(spark):
    docs = spark.createDataFrame([(2**62 + 1, "a b c"), (None, "d e")], "doc_id long, text string")
    assert {r["doc_id"] for r in M.fill_in_middle(docs).collect()} == {2**62 + 1, None}


def test_plan_has_no_shuffle(docs):
    assert "Exchange" not in M.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
