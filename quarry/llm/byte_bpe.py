"""Token counts of a byte-level BPE by rank-synchronous merging in numpy.

The vocabulary file is a parameter and is only read.  A text is split at added
tokens and then into pre-tokens; the distinct pre-tokens of a batch that the
bounded cache lacks are laid out as one ragged array of symbols.  In every
round each sequence merges all occurrences of its own lowest-ranked pair, all
sequences at once, until no sequence has a pair left; what remains is counted.
A merge's result has a later rank than the merge, so merging all occurrences
at once gives what merging them one by one from the left gives.

A pre-token of over ``LONG`` bytes, such as unbroken base64 or unspaced script,
would pass over all its symbols once a rank.  Its symbols are linked arrays, and
the places of each rank's pairs are indexed, so that a round touches the
occurrences of the lowest rank and their neighbours alone.

Defined results: a null or empty text has no tokens; two pairs never tie, as each
has a rank of its own, and places of one pair merge from the left; texts are counted whole;
repeated rows and null ids are kept; an empty table gives no rows; other
columns are left out.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

_NONE = np.iinfo(np.int64).max
LONG = 2_000      # bytes of a pre-token that is merged by itself
CACHED = 200      # characters of the longest pre-token that the cache keeps


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it is printable
    Latin-1, else the next unused code point from 256 on."""
    shown = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else spare))
        spare += b not in shown
    return out


class PreTokens:
    """Splits texts as the byte-level pre-tokenizer does, added tokens first."""

    # Fixed value: the public pre-token pattern, with white space by its Unicode property.
    PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
               r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
    ASCII = (r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+"
             r"|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")

    def __init__(self, spec: dict):
        pre = spec.get("pre_tokenizer") or {}
        if (spec["model"]["type"], pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex"),
                spec.get("normalizer")) != ("BPE", "ByteLevel", False, True, None):
            raise ValueError("not a byte-level BPE without prefix space and normalizer")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest = sorted(self.added, key=len, reverse=True)
        self._added = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self._ascii = re.compile(self.ASCII).findall
        self._any = regex.compile(self.PATTERN).findall
        self._library = ByteLevel(add_prefix_space=False, use_regex=True)
        self._agreed: set[str] = set()
        self._odd: set[str] = set()

    def __call__(self, text: str) -> tuple[list[str], list[str]]:
        """(pre-tokens, added tokens) of a text; see ``parts`` for their order."""
        words, added = [], []
        for part, is_added in self.parts(text):
            if is_added:
                added.append(part)
            else:
                words += self.words(part)
        return words, added

    def words(self, part: str) -> list[str]:
        if part.isascii():
            return self._ascii(part)
        chars = set(part)
        if not chars <= self._agreed:
            for c in chars - self._agreed - self._odd:
                (self._agreed if self._library_words(f"a{c}b {c}1") == self._any(f"a{c}b {c}1")
                 else self._odd).add(c)
            if chars & self._odd:
                return self._library_words(part)
        return self._any(part)

    def _library_words(self, part: str) -> list[str]:
        """Pre-tokens as the library cuts them: for texts with characters that
        its Unicode tables class otherwise than ours do (newly assigned ones)."""
        return [part[a:b] for _, (a, b) in self._library.pre_tokenize_str(part)]

    def parts(self, text: str) -> list[tuple[str, bool]]:
        if self._added is None or not any(a in text for a in self.added):
            return [(text, False)]
        return [(p, i % 2 == 1) for i, p in enumerate(self._added.split(text)) if p]


class RankMerger:
    """Counts the tokens of many pre-tokens at once."""

    def __init__(self, spec: dict):
        vocab = spec["model"]["vocab"]
        self.byte_id = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.base = max(vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        code = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.by_rank = code
        self.rank = np.argsort(code, kind="stable")
        self.code = code[self.rank]

    def _ranks(self, sym: np.ndarray, seq: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each symbol, _NONE where there is none."""
        out = np.full(len(sym), _NONE)
        if len(sym) < 2 or not len(self.code):
            return out
        code = sym[:-1] * self.base + sym[1:]
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        known = (self.code[at] == code) & (seq[:-1] == seq[1:])
        out[:-1][known] = self.rank[at[known]]
        return out

    def long_count(self, raw: bytes) -> int:
        """Tokens of one long pre-token."""
        sym = self.byte_id[np.frombuffer(raw, np.uint8)]
        n = left = len(sym)
        after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        ranks: list[int] = []                     # a heap
        places: dict[int, list[np.ndarray]] = {}  # rank -> where its pairs begin, or did once

        def index(at: np.ndarray) -> None:
            at = at[after[at] < n]
            code = sym[at] * self.base + sym[after[at]]
            spot = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
            known = self.code[spot] == code
            at, rank = at[known], self.rank[spot[known]]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, part in zip(rank[np.r_[0, cuts]].tolist() if len(rank) else (), np.split(at, cuts)):
                if r not in places:
                    heapq.heappush(ranks, r)
                places.setdefault(r, []).append(part)

        if len(self.code):
            index(np.arange(n))
        while ranks:
            rank = heapq.heappop(ranks)
            at = np.unique(np.concatenate(places.pop(rank)))
            at = at[alive[at] & (after[at] < n)]
            at = at[sym[at] * self.base + sym[after[at]] == self.by_rank[rank]]
            if not len(at):
                continue
            # Of a run of overlapping pairs (one symbol repeated) every other one merges.
            starts = np.r_[True, after[at[:-1]] != at[1:]]
            run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            gone = after[at]
            sym[at], alive[gone] = self.result[rank], False
            after[at] = after[gone]
            inner = after[at] < n
            before[after[at][inner]] = at[inner]
            left -= len(at)
            lower = before[at]
            index(np.union1d(lower[lower >= 0], at))
        return left

    def counts(self, words: list[str]) -> np.ndarray:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        long = [i for i, w in enumerate(raw) if len(w) > LONG]
        by_itself = [self.long_count(raw[i]) for i in long]
        for i in long:
            raw[i] = b""
        total = self._short_counts(raw)
        total[long] = by_itself
        return total

    def _short_counts(self, raw: list[bytes]) -> np.ndarray:
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        sym = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        seq = np.repeat(np.arange(len(raw)), length)
        total = length.copy()
        while len(sym):
            rank = self._ranks(sym, seq)
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            span = np.diff(np.r_[first, len(seq)])
            low = np.repeat(lowest, span)
            hit = (rank == low) & (low != _NONE)
            # Of a run of overlapping hits (one symbol repeated) every other one merges.
            at = np.flatnonzero(hit)
            if not len(at):
                break
            starts = np.r_[True, np.diff(at) != 1]
            run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            sym[at] = self.result[rank[at]]
            keep = np.repeat(lowest != _NONE, span)  # sequences without a pair are done
            keep[at + 1] = False
            np.subtract.at(total, seq[at], 1)
            sym, seq = sym[keep], seq[keep]
        return total


class TokenCounter:
    """Counts tokens of texts; the cache of pre-tokens is bounded."""

    def __init__(self, path: str, cache_words: int = 300_000, batch_chars: int = 1_000_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.split, self.merger = PreTokens(spec), RankMerger(spec)
        self.cache: dict[str, int] = {}
        self.cache_words, self.batch_chars = cache_words, batch_chars

    def _batch(self, texts: list[str]) -> list[int]:
        found = [self.split(t) for t in texts]
        cache = self.cache
        if len(cache) > self.cache_words:
            cache.clear()
        new = list({w for words, _ in found for w in words if w not in cache})
        if new:
            cache.update(zip(new, self.merger.counts(new).tolist(), strict=True))
        counts = [sum(map(cache.__getitem__, words)) + len(added) for words, added in found]
        for w in new:  # the cache is bounded in entries, and so in bytes
            if len(w) > CACHED:
                del cache[w]
        return counts

    def __call__(self, texts: Iterable[str | None]) -> list[int]:
        out, held, chars = [], [], 0
        for t in texts:
            held.append(t or "")
            chars += len(held[-1])
            if chars >= self.batch_chars:
                out += self._batch(held)
                held, chars = [], 0
        return out + self._batch(held) if held else out


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = TokenCounter(vocabulary)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch.pop("text")]
            yield batch.assign(n_tokens=pd.Series(counter(texts), index=batch.index, dtype="int64"))

    id_type = docs.schema[id_col].dataType.simpleString()
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    counted = sized.mapInPandas(run, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
