"""MinHash near-dedup with HyperMinHash registers.

A document is its set of distinct five-word shingles.  Its signature has
``REGISTERS`` buckets; each keeps, of the least hash that falls into it, the
count of leading zeros and the next ``MANTISSA`` bits, in 16 bits.  An empty
bucket borrows from a fixed random order of the others, so short texts have
whole signatures.  Four registers make a band; documents that share a band's
value are candidates.  A candidate's Jaccard estimate is the share of equal
registers, corrected for the collisions that compressed registers show by
chance; what the estimate does not rule out is confirmed on the full sets.

Steps, all Spark jobs over written tables:

1. signatures of all texts; texts with equal sets become one class with a
   number of its own, a text of its least id stands for it (copies meet
   nothing but this grouping);
2. bands with two or more classes; classes that bands join form clusters;
3. full sets of the clustered classes only, from a second pass over the texts;
4. a cluster is resolved in one task: band collisions, estimates from the
   highest down, exact check of each pair that is not yet connected;
5. a cluster too large for one task is first thinned: every class is checked
   against the representatives it shares most bands with.  Members outside the
   cluster's largest verified group then meet all members as a grid of blocks;
6. classes that hold texts of one id are linked; components take their least id.

No pair that shares a band goes unchecked unless it is already connected.  Two
documents at the threshold share no band with a chance of
(1 - 0.75 ** 4) ** 50, about 6e-9.

Defined results: null, empty and wordless texts have the empty set and link
with nothing; fewer than five words are one shingle; whole texts are used;
repeated rows share a class; rows without id link with nothing and belong to
no component; rows with one id and different texts are versions of one
document and joined by it; an empty table gives no rows; other columns are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import forget, small, written
from quarry.llm.graph import components
from quarry.llm.shingles import Shingler, jaccard_parts, mix64

BANDS, ROWS = 50, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Pairs estimated under this are not confirmed: 6.5 standard errors below 0.75.
LEAST_ESTIMATE = 0.55
#: A cluster of at most so many classes and bytes of sets is one task.
BLOCK_CLASSES, BLOCK_BYTES = 4000, 32 << 20

_SALT = np.uint64(0x9E3779B97F4A7C15)
_BORROW = np.stack([np.random.Generator(np.random.PCG64(1000 + b)).permutation(REGISTERS)
                    for b in range(REGISTERS)])


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (uint16) of a non-empty set of shingle hashes."""
    h = np.sort(mix64(shingles ^ _SALT))
    # The high half of the hash names the bucket, the low half is the value:
    # in sorted order the high halves rise, so the least value needs its own sort.
    bucket = ((h >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
    value = mix64(h) >> np.uint64(1)
    order = np.lexsort((value, bucket))
    bucket, value = bucket[order].astype(np.int64), value[order]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    least = value[first]
    # 63-bit values: leading zeros, then the bits behind the leading one.
    bits = np.frexp(least.astype(np.float64))[1]
    bits -= (bits > 0) & (least < np.left_shift(np.uint64(1), np.maximum(bits - 1, 0).astype(np.uint64)))
    zeros = np.minimum(63 - bits, 62)
    shift = (bits - 1 - MANTISSA).clip(-63, 63)
    up = np.left_shift(least, np.maximum(-shift, 0).astype(np.uint64))
    mantissa = np.right_shift(up, np.maximum(shift, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    out = np.zeros(REGISTERS, np.uint16)
    has = np.zeros(REGISTERS, bool)
    at = bucket[first]
    out[at] = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    has[at] = True
    empty = np.flatnonzero(~has)
    if len(empty):
        out[empty] = out[_BORROW[empty, has[_BORROW[empty]].argmax(1)]]
    return out


def estimate(equal_share: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimate from the share of equal registers of sets of n and m.

    The chance collision rate is the published approximation for registers
    with ``MANTISSA`` bits (its constant is a fixed value)."""
    n, m = n.astype(float), m.astype(float)
    by_chance = 0.169919487159739 * 2.0**-MANTISSA * 4 * n * m / (n + m) ** 2
    return np.maximum(0.0, (equal_share - by_chance) / (1 - by_chance))


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(shingles.tobytes())
    return tuple(int.from_bytes(d[i:i + 8], "little", signed=True) for i in (0, 8))


# -- steps ---------------------------------------------------------------------

def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, version (hash of the text), n_shingles, d1, d2 (digest of the set),
    registers (null: empty set)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler()
        for batch in batches:
            rows = []
            for doc_id, version, text in zip(batch["doc_id"], batch["version"], batch["text"], strict=True):
                s = shingle(text if isinstance(text, str) else "")
                rows.append((doc_id, version, len(s), *(_digest(s) if len(s) else (0, 0)),
                             registers(s).tobytes() if len(s) else None))
            yield pd.DataFrame(rows, columns=["doc_id", "version", "n_shingles", "d1", "d2", "registers"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return _versions(docs, id_col, text_col).mapInPandas(
        run, f"doc_id {id_type}, version long, n_shingles long, d1 long, d2 long, registers binary")


def _versions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, version, text: rows of one id are told apart by their text's hash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("version"),
                       F.col(text_col).alias("text"))


def _banded(classes: DataFrame) -> DataFrame:
    """(key, rep): a row for every band of every class."""
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    return classes.select("rep", "registers", band.alias("band")).select("rep", F.xxhash64(
        "band", F.substring("registers", F.col("band") * 2 * ROWS + 1, F.lit(2 * ROWS))).alias("key"))


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """rep, cluster, n, registers, shingles (binary) of the wanted classes
    (rep, of_id, of_version, d1, d2, cluster)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler()
        for batch in batches:
            rows, held = [], 0
            for rep, cluster, d1, d2, text in batch[["rep", "cluster", "d1", "d2", "text"]].itertuples(index=False):
                s = shingle(text)
                if _digest(s) == (d1, d2):  # not another text of the same id and hash
                    rows.append((rep, cluster, len(s), registers(s).tobytes(), s.tobytes()))
                    held += s.nbytes
                if held > 8_000_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=columns)

    columns = ["rep", "cluster", "n", "registers", "shingles"]
    # The texts stream past the hashed narrow side, unsorted.
    rows = _versions(docs, id_col, text_col).join(wanted.hint("shuffle_hash"), (
        F.col("doc_id") == F.col("of_id")) & (F.col("version") == F.col("of_version")))
    return rows.select("rep", "cluster", "d1", "d2", "text").mapInPandas(
        run, "rep long, cluster long, n long, registers binary, shingles binary")


def _same_id(signed: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links (u, v) between the classes of every id that has several; None without such an id."""
    ids = signed.groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("d1", "d2") for f in (F.min, F.max)])
    ids = written(ids.where("min_d1 < max_d1 or min_d2 < max_d2").select("doc_id"), "hmh-versions")
    if not ids.limit(1).count():
        return None
    held = written(signed.join(small(ids), "doc_id").select("doc_id", "d1", "d2").distinct()
                   .join(classes.select("d1", "d2", "rep"), ["d1", "d2"]).select("doc_id", "rep"), "hmh-versions-held")
    hubs = written(held.groupBy("doc_id").agg(F.min("rep").alias("v")), "hmh-versions-hubs")
    return held.join(hubs, "doc_id").where("rep <> v").select(F.col("rep").alias("u"), "v")


class _Members:
    """Classes of one task as arrays."""

    def __init__(self, group: pd.DataFrame):
        group = group.drop_duplicates("rep")  # repeated rows of one id and text
        self.rep = group["rep"].to_numpy()
        self.group = group["comp"].to_numpy()
        self.n = group["n"].to_numpy()
        self.sets = group["shingles"].tolist()
        raw = b"".join(group["registers"])
        self.regs = np.frombuffer(raw, np.uint16).reshape(len(group), REGISTERS)
        self.bands = np.frombuffer(raw, np.uint64).reshape(len(group), BANDS)


def confirmed(a: bytes, b: bytes, percent: int = 75) -> bool:
    inter, union = jaccard_parts(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))
    return 100 * inter >= percent * union


def resolve(left: _Members, right: _Members, rows: int = 128) -> list[tuple[int, int]]:
    """Confirmed links between left and right that connect all that is linked.

    A few rows of ``left`` at a time meet all of ``right``; pairs already
    connected drop out before they are estimated, so memory is that of one strip.
    """
    names, group = np.unique(np.r_[left.group, right.group], return_inverse=True)
    group_left, group_right = group[:len(left.rep)], group[len(left.rep):]
    root = np.arange(len(names))
    links: list[tuple[int, int]] = []

    def settle():
        nonlocal root
        while (root[root] != root).any():
            root = root[root]

    for at in range(0, len(left.rep), rows):
        strip = slice(at, at + rows)
        shared = np.zeros((len(group_left[strip]), len(right.rep)), bool)
        for b in range(BANDS):
            shared |= left.bands[strip, b, None] == right.bands[None, :, b]
        shared &= root[group_left[strip]][:, None] != root[group_right][None, :]
        if left is right:
            shared &= np.arange(len(right.rep))[None, :] > np.arange(at, at + len(shared))[:, None]
        i, j = np.nonzero(shared)
        i += at
        guess = np.empty(len(i), np.float32)
        for cut in range(0, len(i), 20_000):
            p, q = i[cut:cut + 20_000], j[cut:cut + 20_000]
            guess[cut:cut + 20_000] = estimate((left.regs[p] == right.regs[q]).mean(1), left.n[p], right.n[q])
        order = np.argsort(-guess, kind="stable")[:int((guess >= LEAST_ESTIMATE).sum())]
        i, j, step = i[order], j[order], 200
        while len(i):
            # Some pairs one by one, then all that their links have connected drop out.
            for a, b in zip(i[:step].tolist(), j[:step].tolist(), strict=True):
                x, y = group_left[a], group_right[b]
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                if x != y and confirmed(left.sets[a], right.sets[b]):
                    root[max(x, y)] = min(x, y)
                    links.append((int(left.rep[a]), int(right.rep[b])))
            settle()
            i, j = i[step:], j[step:]
            apart = root[group_left[i]] != root[group_right[j]]
            i, j, step = i[apart], j[apart], min(2 * step, 20_000)
    return links


def _resolve_group(group: pd.DataFrame) -> pd.DataFrame:
    both, left, right = (group[group["side"] == s] for s in (2, 0, 1))
    links = []
    if len(both):
        members = _Members(both)
        links = resolve(members, members)
    elif len(left) and len(right):
        links = resolve(_Members(left), _Members(right))
    return pd.DataFrame(links, columns=["u", "v"], dtype="int64")


def _thinned(stars: DataFrame, sets: DataFrame, large: DataFrame) -> DataFrame:
    """Confirmed links of classes in large clusters with the two representatives
    they share most bands with."""
    wide = stars.join(large, "cluster", "left_semi").groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("bands"))
    turn = F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("bands"), "pivot"))
    pairs = wide.withColumn("turn", turn).where("turn <= 2").select("rep", "pivot")
    mine = sets.select("rep", "n", "registers", "shingles")
    other = sets.select(F.col("rep").alias("pivot"), F.col("n").alias("n2"), F.col("registers").alias("registers2"),
                        F.col("shingles").alias("shingles2"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            a, b = (np.frombuffer(b"".join(batch[c]), np.uint16).reshape(len(batch), REGISTERS)
                    for c in ("registers", "registers2"))
            guess = estimate((a == b).mean(1), batch["n"].to_numpy(), batch["n2"].to_numpy())
            ok = [g >= LEAST_ESTIMATE and confirmed(x, y)
                  for g, x, y in zip(guess, batch["shingles"], batch["shingles2"], strict=True)]
            yield batch.loc[ok, ["rep", "pivot"]].rename(columns={"rep": "u", "pivot": "v"})

    return pairs.join(mine, "rep").join(other, "pivot").mapInPandas(check, "u long, v long")


def _grid(sets: DataFrame, comps: DataFrame | None, block_classes: int, block_bytes: int) -> DataFrame:
    """Members of every unfinished cluster, dealt to the tasks that resolve it."""
    members = sets.withColumn("comp", F.col("rep"))
    if comps is not None:
        members = sets.join(comps, F.col("rep") == F.col("node"), "left").withColumn(
            "comp", F.coalesce("component", "rep")).drop("node", "component")
    groups = members.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    clusters = groups.groupBy("cluster").agg(
        F.max(F.struct("c", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("comps"),
        F.sum("c").alias("c"), F.sum("s").alias("s"),
        F.max("c").alias("main_c"), F.max("s").alias("main_s")).where("comps > 1")

    def blocks(c, s):
        return F.greatest(F.ceil(c / block_classes), F.ceil(s * 8 / block_bytes), F.lit(1)).cast("long")

    clusters = clusters.select(
        "cluster", "main", blocks(F.col("c"), F.col("s")).alias("right_blocks"),
        F.least(blocks(F.col("c") - F.col("main_c") + 1, F.col("s")), blocks(F.col("c"), F.col("s"))).alias("left_blocks"))
    dealt = members.join(small(written(clusters, "hmh-clusters")), "cluster")
    spot = F.xxhash64("rep")
    whole = dealt.where("right_blocks = 1").select("*", F.lit(2).alias("side"), F.lit(0).cast("long").alias("i"),
                                                   F.lit(0).cast("long").alias("j"))
    wide = dealt.where("right_blocks > 1")
    zero = F.lit(0).cast("long")
    left = wide.where("comp <> main").select(
        "*", F.lit(0).alias("side"), F.pmod(spot, "left_blocks").alias("i"),
        F.explode(F.sequence(zero, F.col("right_blocks") - 1)).alias("j"))
    right = wide.select("*", F.lit(1).alias("side"), F.explode(F.sequence(zero, F.col("left_blocks") - 1)).alias("i"),
                        F.pmod(spot, "right_blocks").alias("j"))
    return whole.unionByName(left).unionByName(right).select(
        "cluster", "i", "j", "side", "rep", "comp", "n", "registers", "shingles")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    block_classes: int = BLOCK_CLASSES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    signed = written(signatures(docs, id_col, text_col), "hmh-signed")
    linked = signed.where("n_shingles > 0 and doc_id is not null")
    # Numbered, as one id can be the least of several classes; written, so that a class keeps its number.
    classes = written(linked.groupBy("d1", "d2").agg(
        F.min(F.struct("doc_id", "version")).alias("least"), F.first("registers").alias("registers")).select(
            "d1", "d2", F.col("least.doc_id").alias("of_id"), F.col("least.version").alias("of_version"),
            "registers", F.monotonically_increasing_id().alias("rep")), "hmh-classes")
    banded = _banded(classes)
    # Written, so that Spark can split a hot band in the join that follows.
    shared = written(banded.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("rep").alias("pivot"))
                     .where("c > 1").select("key", "pivot"), "hmh-shared")
    stars = written(banded.join(shared, "key").where("rep <> pivot").select("rep", "pivot"), "hmh-stars")

    cluster_of = components(stars.select(F.col("rep").alias("u"), F.col("pivot").alias("v")), "hmh-cluster")
    mins = cluster_of.select(F.col("component").alias("node"), "component").distinct()
    members = written(cluster_of.unionByName(mins), "hmh-members")
    wanted = members.join(classes.drop("registers"), F.col("node") == F.col("rep")).select(
        "rep", "of_id", "of_version", "d1", "d2", F.col("component").alias("cluster"))
    sets = written(_full_sets(docs, wanted, id_col, text_col), "hmh-sets")

    sizes = sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    large = written(sizes.where((F.col("c") > block_classes) | (F.col("s") * 8 > block_bytes)).select("cluster"),
                    "hmh-large")
    thin = comps = None
    if large.limit(1).count():
        of = members.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
        thin = written(_thinned(stars.join(of, "rep"), sets, large), "hmh-thin")
        comps = components(thin, "hmh-thin-components")
    links = _grid(sets, comps, block_classes, block_bytes).groupBy("cluster", "i", "j").applyInPandas(
        _resolve_group, "u long, v long")
    for more in (thin, _same_id(linked, classes)):
        links = links if more is None else links.unionByName(more)
    component = components(written(links, "hmh-links"), "hmh-components")
    groups = component.select("component").distinct().select(F.col("component").alias("node"), "component")
    groups = component.unionByName(groups).join(classes.select("rep", "of_id"), F.col("node") == F.col("rep"))
    groups = written(groups.groupBy("component").agg(F.min("of_id").alias("least_id")), "hmh-groups")
    for t in (shared, stars, sets):
        forget(t)
    of_class = classes.select("d1", "d2", "rep", "of_id").join(component, F.col("rep") == F.col("node"), "left").select(
        "d1", "d2", "of_id", F.coalesce("component", "rep").alias("component")).join(
            small(groups), "component", "left").select("d1", "d2", F.coalesce("least_id", "of_id").alias("class_component"))
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(of_class, ["d1", "d2"], "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(
        F.col("class_component"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component, with all its columns; where the kept id
    has several rows, one of them stays.  Rows without id all stay."""
    kept = written(near_duplicates(docs, id_col, text_col, **options).where("kept and doc_id is not null")
                   .groupBy(F.col("doc_id").alias("kept_id")).agg((F.count(F.lit(1)) > 1).alias("repeated")), "hmh-kept")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), F.col(id_col).alias("row_id"))
    found = rows.join(kept.hint("shuffle_hash"), F.col("row_id") == F.col("kept_id"))
    out = found.where("not repeated").select("own.*").unionByName(rows.where("row_id is null").select("own.*"))
    if kept.where("repeated").limit(1).count():
        out = out.unionByName(found.where("repeated").dropDuplicates(["row_id"]).select("own.*"))
    return out
