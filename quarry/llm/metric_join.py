"""Embedding near-duplicates by an exact metric range join.

Vectors of one label are compared by angle, a metric.  Pivots, sampled by hash,
cut a label's vectors into cells; a vector's home is its nearest pivot.  By the
triangle inequality every partner of a home vector of cell ``j`` lies within
``2 * radius`` more of pivot ``j`` than of its own pivot, and within the cell's
extent plus ``radius``: such vectors are replicated to cell ``j``.  A first pass
finds the extents alone, so that only what passes both bounds is ever written.
Cells are then joined on their own, a cell too large for one task as a grid of
blocks of bounded bytes.

A home vector meets all its partners in its home cell, so links are counted
there; for components a task returns a spanning forest of what it saw, not the
links.  Equal vectors are one class from the start: a vector that a third of
all rows repeat is compared once.

The pivots are the only broadcast table, at most ``max_pivots`` vectors.  How
much is replicated depends on the data: tight clusters hardly at all; vectors
without any structure would go to nearly every cell of their label.  It is
measured on a sample of each label, and a label whose vectors would be copied
more often than as one cell's grid of blocks (and more than ``FEW_COPIES`` times)
becomes that one cell: as exact, and never worse than comparing all by blocks.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and those without label or id, link with nothing (component: own
id); only vectors of equal length are compared; repeated rows are one vector,
each returned; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import forget, small, written
from quarry.llm.graph import components

_SLACK = 1e-6  # added to angles, far above rounding
FEW_COPIES = 8
SAMPLE = 500   # vectors of a label whose copies are counted before it is cut into cells
BLOCK_BYTES = 16 << 20


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def _unit(column) -> np.ndarray:
    x = np.array(list(column), dtype=np.float64)
    # Scaled by the largest component first, so squares neither vanish nor overflow.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, embedding, label, dim, usable, and a 128-bit key of the vector."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
              & finite & F.exists(v, lambda x: x != 0))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"),
                          F.col(label_col).alias("label"))
    return (rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
            .withColumn("dim", F.size("embedding"))
            .withColumn("k1", F.xxhash64("embedding")).withColumn("k2", F.xxhash64(F.lit(7), "embedding")))


def _spanning(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links (node, least node) that connect what the linked pairs of ``mask`` connect."""
    rows, cols = mask.any(1), mask.any(0)
    mask, left, right = mask[rows][:, cols], left[rows], right[cols]
    if not mask.size:
        return []
    nodes, at = np.unique(np.r_[left, right], return_inverse=True)
    lab = np.arange(len(nodes))
    a, b = at[:len(left)], at[len(left):]
    big = len(nodes)
    while True:
        before = lab.copy()
        np.minimum.at(lab, a, np.where(mask, lab[b][None, :], big).min(1))
        np.minimum.at(lab, b, np.where(mask, lab[a][:, None], big).min(0))
        lab = lab[lab]
        if (lab == before).all():
            break
    moved = lab != np.arange(len(nodes))
    return list(zip(nodes[moved].tolist(), nodes[lab[moved]].tolist(), strict=True))


def _classes(base: DataFrame) -> DataFrame:
    return base.where("usable").groupBy("label", "dim", "k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies"),
        F.first("embedding").alias("embedding"))


def _pivots(classes: DataFrame, cell_size: int, max_pivots: int) -> pd.DataFrame:
    """label, dim, embedding of the pivots; none for a label that fits one cell."""
    cell = max(cell_size, classes.count() / max_pivots)
    counts = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell)
    # The least hashes of a label: a fixed random sample of about n / cell rows.
    share = F.col("n") / cell / F.col("n")
    picked = classes.join(small(written(counts, "metric-counts")), ["label", "dim"]).where(
        (F.shiftrightunsigned(F.xxhash64(F.lit(3), "k1", "k2"), 11) / float(2**53)) < share)
    return picked.select("label", "dim", "embedding").limit(4 * max_pivots).toPandas()


def _block_rows(dim: int) -> int:
    """Vectors of a block: some ``BLOCK_BYTES`` in double precision."""
    return max(1024, BLOCK_BYTES // (8 * dim))


def _strips(batches, pivots: dict):
    """(label and dim, rows, angles to the pivots) of some rows of a batch that have pivots."""
    for batch in batches:
        for key, group in batch.groupby(["label", "dim"]):
            if key in pivots:
                for at in range(0, len(group), 1024):
                    part = group.iloc[at:at + 1024]
                    yield key, part, _angles(_unit(part["embedding"]), pivots[key])


def _extents(classes: DataFrame, pivots: dict) -> dict[tuple, tuple[np.ndarray, int]]:
    """Of each label with pivots: how far each cell's home vectors reach (-inf
    without any), and how many vectors there are.

    All pivots that are nearest up to rounding count, as the pass that deals the
    vectors out may round a tie the other way."""

    def homes(batches):
        for (label, dim), _, angle in _strips(batches, pivots):
            row, cell = np.nonzero(angle <= angle.min(1, keepdims=True) + _SLACK)
            first = np.r_[True, row[1:] != row[:-1]]
            yield pd.DataFrame({"label": label, "dim": dim, "cell": cell, "angle": angle[row, cell], "first": first},
                               index=range(len(row)))

    kind = classes.schema["label"].dataType.simpleString()
    rows = classes.select("label", "dim", "embedding").mapInPandas(
        homes, f"label {kind}, dim int, cell int, angle double, first boolean").groupBy("label", "dim", "cell").agg(
            F.max("angle").alias("extent"), F.sum(F.col("first").cast("int")).alias("n"))
    out = {key: (np.full(len(p), -np.inf), 0) for key, p in pivots.items()}
    for r in rows.collect():  # a row a pivot
        reach, n = out[r["label"], r["dim"]]
        reach[r["cell"]] = r["extent"]
        out[r["label"], r["dim"]] = reach, n + r["n"]
    return out


def _cells_of(angle: np.ndarray, reach: np.ndarray, radius: float) -> np.ndarray:
    """The cells that each vector goes to."""
    return (angle <= angle.min(1, keepdims=True) + 2 * radius) & (angle <= reach + radius)


def _worth_cutting(classes: DataFrame, pivots: dict, extents: dict, radius: float, block: int | None) -> set[tuple]:
    """The labels whose vectors, by a sample of each, go to fewer cells than a
    grid of blocks would copy them."""

    def counted(batches):
        for (label, dim), part, angle in _strips((sampled(b) for b in batches), pivots):
            cells = _cells_of(angle, extents[label, dim][0], radius).sum()
            yield pd.DataFrame([(label, dim, int(cells), len(part))], columns=["label", "dim", "cells", "n"])

    def sampled(batch):
        share = np.array([min(1.0, SAMPLE / max(extents[k][1], 1)) if (k := key) in extents else 0.0
                          for key in zip(batch["label"], batch["dim"])])
        return batch[(batch["k1"].to_numpy() & 0xFFFFF) / 2**20 < share]

    kind = classes.schema["label"].dataType.simpleString()
    rows = classes.select("label", "dim", "k1", "embedding").mapInPandas(
        counted, f"label {kind}, dim int, cells long, n long").groupBy("label", "dim").agg(
            F.sum("cells").alias("cells"), F.sum("n").alias("n")).collect()  # a row for each label with pivots
    out = set()
    for r in rows:
        key = r["label"], r["dim"]
        blocks = -(-extents[key][1] // (block or _block_rows(key[1])))
        if r["cells"] / r["n"] <= max(FEW_COPIES, 2 * blocks):
            out.add(key)
    return out


def range_join(vectors: DataFrame, least_cosine: float = 0.93, cell_size: int = 2500, max_pivots: int = 4096,
               block: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
               label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector.

    ``block``: vectors of a block, by default as many as ``BLOCK_BYTES`` hold."""
    radius = math.acos(least_cosine) + _SLACK
    base = written(_prepared(vectors, id_col, vector_col, label_col), "metric-base")
    classes = written(_classes(base), "metric-classes")
    pivots: dict[tuple, np.ndarray] = {}
    for key, group in _pivots(classes, cell_size, max_pivots).groupby(["label", "dim"]):
        pivots[key] = _unit(group["embedding"])

    extents = _extents(classes, pivots) if pivots else {}
    cut = _worth_cutting(classes, pivots, extents, radius, block) if pivots else set()
    pivots = {k: v for k, v in pivots.items() if k in cut}

    def assign(batches):
        """Every class in its home cell and in those whose home vectors may be its partners."""
        for batch in batches:
            for key, group in batch.groupby(["label", "dim"]):
                if key not in pivots:
                    yield group.assign(cell=0, home=True)[columns]
            for key, part, angle in _strips([batch], pivots):
                home = angle.argmin(1)
                row, cell = np.nonzero(_cells_of(angle, extents[key][0], radius))
                for at in range(0, len(row), 20_000):
                    rows, cells = row[at:at + 20_000], cell[at:at + 20_000]
                    yield part.iloc[rows].assign(cell=cells, home=home[rows] == cells)[columns]

    columns = ["label", "dim", "cell", "home", "rep", "copies", "embedding"]
    kind = {f.name: f.dataType.simpleString() for f in classes.schema}
    rows = classes.select("label", "dim", "rep", "copies", "embedding").mapInPandas(
        assign, f"label {kind['label']}, dim int, cell int, home boolean, rep {kind['rep']}, "
                f"copies long, embedding {kind['embedding']}")
    cells = written(rows, "metric-cells")
    held = F.greatest(F.lit(1024), F.floor(F.lit(BLOCK_BYTES) / (F.col("dim") * 8))) if block is None else F.lit(block)
    blocks = written(cells.groupBy("label", "dim", "cell").agg(
        F.sum(F.col("home").cast("int")).alias("homes"), F.count(F.lit(1)).alias("rows")).select(
            "label", "dim", "cell", F.ceil(F.col("homes") / held).alias("row_blocks"),
            F.ceil(F.col("rows") / held).alias("col_blocks")), "metric-blocks")
    placed = cells.join(small(blocks), ["label", "dim", "cell"])
    spot = F.xxhash64("rep")
    own_row, own_col = F.pmod(spot, "row_blocks"), F.pmod(spot, "col_blocks")
    # Each row stands once per block of the other side as home, once as partner.
    as_home = placed.where("home").withColumn("side", F.lit(0)).withColumn("i", own_row).withColumn(
        "j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("col_blocks") - 1)))
    as_partner = placed.withColumn("side", F.lit(1)).withColumn("j", own_col).withColumn(
        "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - 1)))
    grid = as_home.unionByName(as_partner).select("label", "dim", "cell", "i", "j", "side", "rep", "copies", "embedding")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sides = [group[group["side"] == s] for s in (0, 1)]
        if not len(sides[0]) or not len(sides[1]):
            return pd.DataFrame([], columns=["u", "v", "n"])
        (a, x), (b, y) = ((s["rep"].to_numpy(), _unit(s["embedding"])) for s in sides)
        copies = sides[1]["copies"].to_numpy()
        out = []
        strip = max(1, (4 << 20) // max(len(b), 1))  # 32 MB of products
        for at in range(0, len(a), strip):
            part = a[at:at + strip]
            mask = (x[at:at + strip] @ y.T >= least_cosine) & (part[:, None] != b[None, :])
            n = mask @ copies
            out += [(u, None, c) for u, c in zip(part[n > 0].tolist(), n[n > 0].tolist(), strict=True)]
            out += [(u, v, 0) for u, v in _spanning(mask, part, b)]
        return pd.DataFrame({"u": pd.Series([r[0] for r in out], dtype="int64"),
                             "v": pd.Series([r[1] for r in out], dtype="Int64"),
                             "n": pd.Series([r[2] for r in out], dtype="int64")})

    found = written(grid.groupBy("label", "dim", "cell", "i", "j").applyInPandas(
        compare, "u long, v long, n long"), "metric-links")
    n_links = found.where("v is null").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("linked"))
    # Classes that share their least id (one id, several vectors) meet there.
    component = components(found.where("v is not null").select("u", "v"), "metric-component")
    known = classes.select("label", "dim", "k1", "k2", "rep", "copies").join(n_links, "rep", "left").join(
        component, F.col("rep") == F.col("node"), "left")
    known = known.select("label", "dim", "k1", "k2", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias(
        "n_links"), F.coalesce("component", "rep").alias("component"))
    for t in (cells, blocks):
        forget(t)
    key = ["label", "dim", "k1", "k2"]
    return (base.select("vec_id", *key, "usable").join(known.withColumn("usable", F.lit(True)), [*key, "usable"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
