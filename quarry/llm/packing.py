"""Best-fit packing of tokenised documents into sequences by bin completion.

Pieces of equal length are interchangeable, so an instance is a histogram: how
many pieces there are of each of the at most ``capacity`` lengths.  Spark counts
it; the histogram (never the pieces) is solved by bin completion, and the
solution, a short list of bin patterns each with the number of bins that have
it, is dealt back to the pieces by their rank among pieces of their length.

Bin completion branches on the largest remaining length: it tries undominated
fillings around it, fullest first, prunes branches whose waste passes what the
incumbent allows, and takes best-fit decreasing as first incumbent.  It searches
in rounds.  The first makes three cuts: a branch has at most ``width`` fillings
found in a bounded number of trials, none that wastes room where one fills the
bin exactly, and a filling goes to as many bins as the histogram allows at once.
The next rounds lift the last two cuts and widen the first fourfold each.  The
search stops at the lower bound (volume, or pieces over half a bin) or with a
round that cut nothing, where the result is proven least, or else with the best
found when a later round has had ``max_nodes`` branches or all later rounds
``max_nodes * STEPS`` trials.

Ranks are prefix sums per (length, hash range): the one length that most
pieces share, a full sequence, is spread over all ranges.

Defined results: a null text is the empty text, one end token; texts are
tokenised whole; repeated rows are packed each on its own; pieces of equal length
trade places freely, and do so by hash, id, piece and checksum; null ids are kept;
an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.byte_bpe import PreTokens, byte_symbols
from quarry.llm.common import written

Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


# -- tokens ------------------------------------------------------------------

class TokenIds:
    """Ids of texts as the ``tokenizers`` library gives them for a byte-level
    BPE file.

    The ids come from ``tiktoken``, some three times as fast, over the same
    file's vocabulary.  Every character that is not ASCII is first tried in
    both libraries; a text with one that they cut differently (their Unicode
    tables differ in newly assigned ones), with an added token or with a long
    run of white space, at some 1,000,000 of which ``tiktoken`` panics, goes
    to ``tokenizers`` itself.  ``tiktoken`` merges in the order of ids: with a
    file whose merges are not in that order all texts do."""

    #: A run of twice as many white-space characters holds a whole block of them.
    SPACE_BLOCK = 50_000

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cutter = PreTokens(spec)  # refuses other kinds of files
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in cutter.added}
        ranks = {bytes(map(byte_of.__getitem__, k)): v for k, v in vocab.items()}
        self.added = list(cutter.added)
        self.fast = tiktoken.Encoding("file", pat_str=PreTokens.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={}).encode_ordinary
        self.library = Tokenizer.from_file(path)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocab[a + b] for a, b in merges]
        if any(x >= y for x, y in zip(made, made[1:])) or len(made) + 256 != len(vocab):
            self.fast = self._by_library
        self.agreed: set[str] = set()
        self.odd: set[str] = set()

    def _by_library(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _long_space(self, text: str) -> bool:
        """True with a run of ``2 * SPACE_BLOCK`` white-space characters, False
        without one of ``SPACE_BLOCK``."""
        step = self.SPACE_BLOCK
        return any(text[i:i + step].isspace() for i in range(0, len(text) - step + 1, step))

    def __call__(self, text: str) -> list[int]:
        if any(a in text for a in self.added) or self._long_space(text):
            return self._by_library(text)
        if not text.isascii():
            chars = set(text)
            if not chars <= self.agreed:
                for c in chars - self.agreed - self.odd:
                    probe = f"a{c}b {c}1"
                    (self.agreed if self.fast(probe) == self._by_library(probe) else self.odd).add(c)
                if chars & self.odd:
                    return self._by_library(text)
        return self.fast(text)


@lru_cache(maxsize=1)
def token_ids(path: str) -> TokenIds:
    """One a worker process: a worker runs many tasks."""
    return TokenIds(path)


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (binary, little-endian uint32).

    Documents longer than ``capacity`` are cut so that only the first piece
    may be shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        encode = token_ids(vocabulary)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            rows: list[tuple] = []  # row of the batch, piece, start, length, ids
            size = 0
            for row in range(batch.num_rows):  # one text at a time is a Python string
                ids = encode(texts[row].as_py() or "")
                ids.append(end_id)
                coded = np.array(ids, "<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                rows += [(row, i, a, b - a, coded[a:b].tobytes()) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                size += coded.nbytes
                if size > 8_000_000:
                    yield pieces_of(doc_ids, rows)
                    rows, size = [], 0
            yield pieces_of(doc_ids, rows)

    def pieces_of(doc_ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        row, piece, start, length, ids = zip(*rows) if rows else ((),) * 5
        return pa.RecordBatch.from_arrays(
            [doc_ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(length, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "piece", "start", "length", "ids"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, piece int, start long, length long, ids binary")


# -- bin completion ------------------------------------------------------------

STEPS = 4000  # trials for the fillings of a branch in the first round


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Counter[Pattern]:
    """Best-fit decreasing over a histogram, equal bins handled together."""
    bins: dict[int, Counter] = {}  # free room -> patterns
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in bins if r >= size), default=None)
            if room is None:
                bins.setdefault(capacity, Counter())[()] += -(-left // (capacity // size))
                room = capacity
            pattern, n = next(iter(bins[room].items()))
            # Once opened, a bin is the tightest fit until it is full for this size.
            most = room // size
            put, used = (most, min(n, left // most)) if left >= most else (left, 1)
            bins[room][pattern] -= used
            if not bins[room][pattern]:
                del bins[room][pattern]
            if not bins[room]:
                del bins[room]
            bins.setdefault(room - put * size, Counter())[(*pattern, (size, put))] += used
            left -= put * used
    out: Counter[Pattern] = Counter()
    for patterns in bins.values():
        out.update({p: n for p, n in patterns.items() if p})
    return out


def fillings(counts: dict[int, int], room: int, waste: int, limit: int,
             steps: int = STEPS) -> tuple[list[Pattern], bool, int]:
    """(undominated ways to fill ``room`` leaving at most ``waste`` free, fullest
    first, are these all?, trials): at most ``limit`` of them, found in at most ``steps`` trials."""
    sizes = sorted((s for s, n in counts.items() if n and s <= room), reverse=True)
    found: list[tuple[int, Pattern]] = []
    trials = 0

    def dominated(pattern: Pattern, free: int) -> bool:
        """Could a larger unused piece stand in for one of the filling's, or one more fit?"""
        used = dict(pattern)
        spare = [s for s in sizes if used.get(s, 0) < counts[s]]
        return bool(spare and spare[-1] <= free) or any(
            s < t <= s + free for s, _ in pattern for t in spare)

    def walk(i: int, free: int, pattern: Pattern) -> bool:
        nonlocal trials
        trials += 1
        if free <= waste and not dominated(pattern, free):
            found.append((free, pattern))
        while i < len(sizes) and sizes[i] > free:
            i += 1
        if not free or i == len(sizes) or trials > steps or len(found) >= limit:
            return trials <= steps and len(found) < limit
        for j in range(i, len(sizes)):
            s = sizes[j]
            for n in range(min(counts[s], free // s), 0, -1):
                if not walk(j + 1, free - n * s, (*pattern, (s, n))):
                    return False
        return True

    whole = walk(0, room, ())
    return [p for _, p in sorted(found, key=lambda x: x[0])], whole, trials


KEPT = 20_000  # choices of open branches held at a time; others are found again on the way back


class _Branch:
    """An open branch: what beats the incumbent allows to waste, its choices
    (pattern, bins, waste a bin) unless dropped, and how many were tried."""

    __slots__ = ("allowed", "choices", "total", "tried", "taken")

    def __init__(self, allowed: int, choices: list[tuple[Pattern, int, int]]):
        self.allowed, self.choices, self.total, self.tried, self.taken = allowed, choices, len(choices), 0, None


def _choices(left: dict[int, int], capacity: int, allowed: int, width: int, lift: int) -> tuple[list, bool, int]:
    """(what may be done with the largest remaining length, is that all?, trials)."""
    top = max(left)
    rest = dict(left)
    rest[top] -= 1
    room, most, steps = capacity - top, width * 4**lift, STEPS * 4**lift
    found, whole, trials = fillings(rest, room, 0, most, steps)
    # Exact fillings first: waste is kept for the last bins, which need it.
    if allowed and room and (lift or not found):
        known = set(found)
        more, whole, tried = fillings(rest, room, min(allowed, room), most, steps)
        trials += tried
        found += [p for p in more if p not in known]
    elif allowed and room:
        whole = False
    out = []
    for filling in found:
        free = room - sum(s * n for s, n in filling)
        pattern = tuple(sorted((Counter(dict(filling)) + Counter({top: 1})).items(), reverse=True))
        bins = min(left[s] // n for s, n in pattern)
        if free:
            bins = min(bins, allowed // free)
        whole &= bool(lift) or bins <= 1
        out += [(pattern, n, free) for n in ((bins, 1) if lift and bins > 1 else (bins,) if bins else ())]
    return out, whole, trials


def complete_bins(counts: dict[int, int], capacity: int, max_nodes: int = 3000,
                  width: int = 12) -> tuple[Counter[Pattern], bool]:
    """(patterns with their numbers of bins, proven least?) for a histogram.

    Depth first on one histogram that decisions change and the way back
    restores: memory is that of one path of decisions and at most ``KEPT``
    choices above its last branch."""
    counts = {s: n for s, n in counts.items() if n}
    volume = sum(s * n for s, n in counts.items())
    least = max(-(-volume // capacity), sum(n for s, n in counts.items() if 2 * s > capacity))
    best = best_fit_decreasing(counts, capacity)
    fewest = sum(best.values())
    lift, proven, trials = 0, fewest == least, 0
    while not proven:
        left, used, wasted = dict(counts), 0, 0
        path: list[_Branch] = []
        reached: dict[bytes, int] = {}  # digest of a remaining histogram -> fewest bins before it
        cut, nodes, kept, dropped, open_ = False, 0, 0, 0, True

        def apply(choice: tuple[Pattern, int, int], sign: int) -> None:
            nonlocal used, wasted
            pattern, n, free = choice
            for size, each in pattern:
                now = left.get(size, 0) - sign * n * each
                if now:
                    left[size] = now
                else:
                    del left[size]
            used, wasted = used + sign * n, wasted + sign * n * free

        while open_ and fewest > least and nodes < max_nodes and trials < max_nodes * STEPS:
            nodes += 1
            allowed = (fewest - 1) * capacity - volume - wasted  # waste that still beats the incumbent
            choices: list = []
            if not left:
                if used < fewest:
                    fewest, best = used, Counter()
                    for branch in path:
                        best[branch.taken[0]] += branch.taken[1]
            elif allowed >= 0:
                state = xxhash.xxh3_128_digest(np.array(sorted(left.items()), np.int64).tobytes())
                if reached.get(state, used + 1) > used:
                    reached[state] = used
                    choices, whole, tried = _choices(left, capacity, allowed, width, lift)
                    trials += tried if lift else 0
                    cut |= not whole
            path.append(_Branch(allowed, choices))
            kept += len(choices)
            while kept > KEPT and dropped < len(path) - 1:  # the longest open are needed last
                kept -= len(path[dropped].choices)
                path[dropped].choices = None
                dropped += 1
            while path and path[-1].tried == path[-1].total:
                done = path.pop()
                kept -= len(done.choices or ())
                dropped = min(dropped, len(path))
                if path:
                    apply(path[-1].taken, -1)
            open_ = bool(path)
            if open_:
                here = path[-1]
                if here.choices is None:
                    here.choices, _, tried = _choices(left, capacity, here.allowed, width, lift)
                    trials += tried if lift else 0
                    kept += here.total
                    dropped = len(path) - 1
                here.taken = here.choices[here.tried]  # the fullest is tried first
                here.tried += 1
                apply(here.taken, 1)
        proven = fewest == least or not (open_ or cut)
        if open_ and lift or trials >= max_nodes * STEPS or not max_nodes:
            break
        lift += 1
    return best, proven


# -- placement -----------------------------------------------------------------

def _runs(patterns: Counter[Pattern]) -> list[tuple]:
    """(length, first_rank, end_rank, first_bin, per_bin, offset): which pieces,
    by rank among their length, go to which bins of which pattern."""
    rows, taken, first_bin = [], Counter(), 0
    for pattern, bins in sorted(patterns.items(), reverse=True):
        offset = 0
        for size, n in pattern:
            rows.append((size, taken[size], taken[size] + n * bins, first_bin, n, offset))
            taken[size] += n * bins
            offset += n * size
        first_bin += bins
    return rows


def place(pieces: DataFrame, capacity: int = 1024, max_nodes: int = 3000) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces (doc_id, piece,
    start, length, ids_crc32)."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in  # at most ``capacity`` rows
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns, _ = complete_bins(histogram, capacity, max_nodes)
    runs = spark.createDataFrame(
        _runs(patterns), "length long, first_rank long, end_rank long, first_bin long, per_bin long, at long")

    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = pieces.withColumn("span", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(ranges)))
    totals = keyed.groupBy("length", "span").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("length", "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    inside = Window.partitionBy("length", "span").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (keyed.withColumn("place", F.row_number().over(inside).cast("long") - 1)
              .join(offsets, ["length", "span"])
              .withColumn("rank", F.col("rows_before") + F.col("place")))
    runs = F.broadcast(runs.withColumnRenamed("length", "run_length"))  # a few rows per length
    return (ranked.join(runs, (F.col("length") == F.col("run_length"))
                        & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
            .withColumn("nth", F.col("rank") - F.col("first_rank"))
            .select(*pieces.columns,
                    (F.col("first_bin") + F.expr("nth div per_bin")).alias("sequence_id"),
                    (F.col("at") + F.col("nth") % F.col("per_bin") * F.col("length")).alias("offset")))


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, max_nodes: int = 3000,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece's place."""
    pieces = token_pieces(docs, vocabulary, capacity, end_id, id_col, text_col)
    slim = written(pieces.select("doc_id", "piece", "start", "length",
                                 F.crc32("ids").alias("ids_crc32")), "pack-pieces")
    return place(slim, capacity, max_nodes)


def sequences(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """sequence_id, ids (little-endian uint32), doc_ids: the packed sequences themselves."""
    pieces = written(token_pieces(docs, vocabulary, **options).withColumn("ids_crc32", F.crc32("ids")),
                     "pack-ids")
    placed = place(pieces, options.get("capacity", 1024))
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))  # one sequence: bounded
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts.ids, cast('' as binary), (a, x) -> concat(a, x))").alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"))
