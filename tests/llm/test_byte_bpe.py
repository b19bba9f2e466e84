import random
import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import byte_bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def tokens(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_documents(docs, library):
    rows = {r["doc_id"]: r for r in B.count_tokens(docs, PATH).collect()}
    for r in docs.collect():
        got = rows[r["doc_id"]]
        assert got["n_tokens"] == tokens(library, r["text"])
        assert got["n_bytes"] == len((r["text"] or "").encode())
        assert got["over_limit"] == (got["n_tokens"] > 512)


def test_random_texts(library):
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "'", "é", "ß", "日", "1", "!", "<|endoftext|>", "\x1c",
             "\x85", " ", "the", "ing", "aaaa", "😀", "́", "՘", "꟎", "౜"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["a" * 4097, " " * 3000, "ab" * 2000, "!?" * 999, "", None, "\ud800"[:0]]
    assert B.TokenCounter(PATH, cache_words=50, batch_chars=500)(texts) == [tokens(library, t) for t in texts]


def test_overlapping_pairs_merge_from_the_left(library):
    for n in range(1, 60):
        assert B.TokenCounter(PATH)(["a" * n])[0] == tokens(library, "a" * n)


def test_tricky(tricky, nothing, library):
    rows = B.count_tokens(tricky, PATH).collect()
    text = {r["doc_id"]: r["text"] for r in tricky.collect()}
    assert len(rows) == tricky.count()
    assert all(r["n_tokens"] == tokens(library, text[r["doc_id"]]) for r in rows)
    assert B.count_tokens(nothing, PATH).collect() == []


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        B.TokenCounter(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("seed, alphabet", [(1, "abcdefghijklmnopqrstuvwxyz"), (2, "ab"), (3, "a"), (4, "日本語のテキスト中文字"),
                                            (5, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")])
def test_long_pre_tokens_against_the_library(seed, alphabet):
    rng = random.Random(seed)
    counter, library = B.TokenCounter(PATH), Tokenizer.from_file(PATH)
    for n in (B.LONG - 1, B.LONG + 1, 10_007, 30_000):
        text = "".join(rng.choice(alphabet) for _ in range(n))
        assert counter([text, f"x {text} y", ""]) == [len(library.encode(t, add_special_tokens=False).ids)
                                                      for t in (text, f"x {text} y", "")]
    assert all(len(w) <= B.CACHED for w in counter.cache)


def test_a_million_unbroken_characters():
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    start = time.perf_counter()
    got = B.TokenCounter(PATH)([text])
    assert time.perf_counter() - start < 20
    assert got == [len(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids)]
