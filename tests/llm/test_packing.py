import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def fewest(items, cap):
    """Least number of bins, over all subsets."""
    best = [(0, cap)] + [(99, 0)] * (2**len(items) - 1)
    for m in range(2**len(items)):
        bins, used = best[m]
        for i, x in enumerate(items):
            if not m >> i & 1:
                then = (bins, used + x) if used + x <= cap else (bins + 1, x)
                best[m | 1 << i] = min(best[m | 1 << i], then)
    return best[-1][0]


def test_bin_completion_against_all_subsets():
    rng = random.Random(7)
    for _ in range(150):
        cap = rng.choice([10, 30, 100])
        low, high = (1, cap) if rng.random() < 0.5 else (cap // 5 + 1, cap // 2)
        items = [rng.randint(low, high) for _ in range(rng.randint(1, 10))]
        patterns, proven = P.complete_bins(dict(Counter(items)), cap)
        assert all(sum(s * n for s, n in p) <= cap for p in patterns)
        used = Counter()
        for p, bins in patterns.items():
            used.update({s: n * bins for s, n in p})
        assert used == Counter(items)
        assert sum(patterns.values()) == fewest(items, cap) or not proven
        assert sum(patterns.values()) <= fewest(items, cap) + 1


def test_small_instances_are_solved_and_proven():
    rng = random.Random(11)
    instances = [(30, [7, 8, 12, 14, 9, 15, 10, 13])]  # one bin too many without wasting or wider fillings
    for _ in range(100):
        cap = rng.choice([10, 30, 100])
        instances.append((cap, [rng.randint(cap // 5 + 1, cap // 2) for _ in range(rng.randint(5, 9))]))
    for cap, items in instances:
        patterns, proven = P.complete_bins(dict(Counter(items)), cap)
        assert proven and sum(patterns.values()) == fewest(items, cap)


def test_completion_ends_where_no_filling_fits_well():
    counts = {s: 40 for s in range(200, 340, 7)}
    patterns, _ = P.complete_bins(counts, 1024, max_nodes=50)
    assert sum(s * n * b for p, b in patterns.items() for s, n in p) == sum(s * n for s, n in counts.items())


def test_completion_beats_best_fit():
    counts = {6: 2, 4: 1, 3: 2, 2: 1, 8: 1}  # 32 in bins of 10
    assert sum(P.complete_bins(counts, 10)[0].values()) == 4


def check(rows, texts, library, cap):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for i, p in enumerate(sorted(by_doc[doc_id], key=lambda r: r["piece"])):
            assert (p["piece"], p["start"]) == (i, at) and (i == 0 or p["length"] == cap)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at:at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    bound = -(-sum(r["length"] for r in rows) // cap)
    assert len(by_seq) <= bound * 1.02 + 1


def test_pack_documents(docs, library):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(P.pack(docs, PATH).collect(), texts, library, 1024)


def test_tricky(tricky, nothing, library):
    rows = P.pack(tricky, PATH, capacity=64).collect()
    seen = Counter(r["doc_id"] for r in tricky.collect())
    once = [(r["doc_id"], r["text"]) for r in tricky.collect() if seen[r["doc_id"]] == 1]
    assert sum(r["doc_id"] == 11 for r in rows) == 2  # the repeated row, packed twice
    lengths = {r["doc_id"]: 0 for r in rows}
    for r in rows:
        lengths[r["doc_id"]] += r["length"]
    for doc_id, text in once:
        assert lengths[doc_id] == len(library.encode(text or "", add_special_tokens=False).ids) + 1
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all(sum(n for _, n in p) <= 64 for p in places.values())
    assert P.pack(nothing, PATH).collect() == []


def test_ids_with_special_strings_and_new_characters(library):
    encode = P.TokenIds(PATH)
    for text in ("a<|endoftext|>b", "<|endoftext|>", "՘x", "꟎ a꟎1", "x" * 3000, "\x1c\x85   é"):
        assert encode(text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 1_200_000, "a b" + "\n" * 1_200_000 + "c", "a" + "\u3000" * 1_200_000,
                                  "x" * 40_000 + " " * 1_000_001])
def test_long_runs_of_white_space(text, library):
    assert P.TokenIds(PATH)(text) == library.encode(text, add_special_tokens=False).ids


def test_pack_a_long_run_of_white_space(spark, library):
    texts = [(1, "a " * 20), (2, "one" + " " * 1_200_000 + "two"), (3, "\n" * 1_200_000)]
    check(P.pack(spark.createDataFrame(texts, "doc_id long, text string"), PATH).collect(), texts, library, 1024)


def test_sequences_hold_their_documents(docs, library):
    some = docs.limit(30)
    texts = {r["doc_id"]: r["text"] for r in some.collect()}
    tokens = Counter()
    for r in P.sequences(some, PATH).collect():
        assert len(r["ids"]) % 4 == 0 and len(r["ids"]) <= 4096
        tokens.update(np.frombuffer(bytes(r["ids"]), "<u4").tolist())
    want = Counter()
    for t in texts.values():
        want.update(library.encode(t or "", add_special_tokens=False).ids + [2])
    assert tokens == want


def test_merges_out_of_the_order_of_ids_go_to_the_library(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    assert P.TokenIds(PATH).fast.__name__ == "encode_ordinary"
    vocab = spec["model"]["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    a, b = ("".join(merges[i]) for i in (0, 400))
    vocab[a], vocab[b] = vocab[b], vocab[a]  # the first merge's token now has a late id
    path = str(tmp_path / "swapped.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    library, encode = Tokenizer.from_file(path), P.TokenIds(path)
    assert encode.fast == encode._by_library
    for text in ("the theatre in the winter", "interesting things there"):
        assert encode(text) == library.encode(text, add_special_tokens=False).ids
