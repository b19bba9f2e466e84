"""Exact top-k search by inner product with a paged M-tree, best first.

Vectors are whole numbers, ``floor(scale * x)``.  Largest inner products become
nearest neighbours in a metric space: with ``M`` the largest squared length, a
vector gets one more coordinate, ``sqrt(M - |v|**2)``, a query gets 0 there, and
``d(q, v)**2 = |q|**2 + M - 2 q.v``.

The tree has three levels, loaded in bulk.  Its root entries are routing objects
sampled by hash, at most ``max_regions``; a vector goes to the nearest one's
region.  A region is dealt into blocks of bounded bytes, and a task turns each
block into pages, each written as one row: routing object, covering radius,
distance to the region's object (the parent distance), and the page's vectors
sorted by their distance to the page's object.

Queries are searched best first, in rounds.  A round sends each query to its
next regions by lower bound, ``d(q, region) - radius``, as long as that beats the
score of its k-th best so far.  Inside a block a queue holds pages by the bound
that the stored parent distances give, without a computation; a page's own
distance is computed when its turn comes, and of its vectors only those whose
stored distance leaves room are multiplied.  Bounds only ever leave out what is
worse than the k-th best, so the result is exact.

All blocks of all regions visited are joined to their queries by a shuffle; a
region that many queries visit is copied for slices of them, and one that holds
many vectors has many blocks.  Of equal vectors the ``k + 1`` least ids are kept,
as no query can return more.

Defined results: vectors that are null, empty or hold null or non-finite
components, and rows without id, take no part; only vectors of equal length
meet; rows alike in id and vector count once, and a row never meets its own id;
ties go to the smaller id; fewer than k others give all of them; a table without
queries gives no rows; other columns are left out.  A component of 2**26 or more
after scaling is an error, as scores could leave 64 bits.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import forget, small, written

LARGEST = 1 << 26
NO_FLOOR = -(1 << 63)  # a query without k found yet


# -- the space -------------------------------------------------------------------

def _matrix(column) -> np.ndarray:
    x = np.array(list(column), np.int64)
    if x.size and int(np.abs(x).max()) >= LARGEST:
        raise ValueError(f"a scaled component is {LARGEST} or more")
    return x


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    top = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if top < 1 << 53:  # every partial sum is exact in a double
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Points:
    """Rows of the metric space: vectors and their additional coordinate."""

    def __init__(self, vectors: np.ndarray, largest: int | None):
        """Stored vectors, or queries where ``largest`` is None."""
        self.v = vectors
        self.squared = (vectors * vectors).sum(1).astype(np.float64)
        self.extra = np.zeros(len(vectors)) if largest is None else np.sqrt(np.maximum(largest - self.squared, 0))

    def take(self, at) -> Points:
        out = Points.__new__(Points)
        out.v, out.squared, out.extra = self.v[at], self.squared[at], self.extra[at]
        return out

    def distances(self, other: Points) -> np.ndarray:
        square = (self.squared[:, None] + other.squared[None, :] - 2.0 * dots(self.v, other.v)
                  + (self.extra[:, None] - other.extra[None, :]) ** 2)
        return np.sqrt(np.maximum(square, 0))


def _origin(dim: int) -> Points:
    """The routing object of lengths of which none was sampled."""
    return Points(np.zeros((1, dim), np.int64), None)


def _strips(points: Points, rows: int = 1024) -> Iterator[tuple[int, Points]]:
    for at in range(0, len(points.v), rows):
        yield at, points.take(slice(at, at + rows))


# -- a block's pages -----------------------------------------------------------------

class Page:
    """A leaf: routing object, radius, parent distance, and its entries by distance."""

    __slots__ = ("centre", "radius", "parent", "ids", "vectors", "distance")

    def __init__(self, centre: Points, radius: float, parent: float, ids: np.ndarray, vectors: np.ndarray,
                 distance: np.ndarray):
        self.centre, self.radius, self.parent = centre, radius, parent
        self.ids, self.vectors, self.distance = ids, vectors, distance


def build_pages(ids: np.ndarray, points: Points, region: Points, page_rows: int) -> list[Page]:
    """Pages of about ``page_rows`` vectors of a block around objects of its own."""
    n = len(ids)
    centres = points.take(np.unique(np.linspace(0, n - 1, -(-n // page_rows)).astype(int)))
    home, distance = np.zeros(n, int), np.zeros(n)
    for at, part in _strips(points):
        d = part.distances(centres)
        home[at:at + len(d)] = d.argmin(1)
        distance[at:at + len(d)] = d.min(1)
    parent = centres.distances(region)[:, 0]
    pages = []
    for c in np.unique(home):
        own = np.flatnonzero(home == c)
        own = own[np.argsort(distance[own], kind="stable")]
        pages.append(Page(centres.take([c]), float(distance[own[-1]]), float(parent[c]), ids[own], points.v[own],
                          distance[own]))
    return pages


class Best:
    """The ``k`` best of a query so far, and what a better one must reach."""

    def __init__(self, k: int, squared: float, largest: int, floor: int | None):
        self.k, self.whole, self.floor = k, squared + largest, floor
        self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.slack = 1e-6 * math.sqrt(largest + 1.0)

    def reach(self) -> float:
        """Nothing farther can be among the best."""
        if self.floor is None:
            return math.inf
        return math.sqrt(max(self.whole - 2.0 * self.floor, 0.0)) + self.slack

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if self.floor is not None:
            good = score >= self.floor
            score, ids = score[good], ids[good]
        if not len(score):
            return
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -score))[:self.k]
        self.score, self.ids = score[first], ids[first]
        if len(first) == self.k:
            self.floor = max(int(self.score[-1]), self.floor if self.floor is not None else int(self.score[-1]))


def search_block(pages: list[Page], query: np.ndarray, own: int, to_region: float, k: int, largest: int,
                 floor: int | None) -> tuple[Best, int]:
    """(best of a block for a query, how many distances and products were computed)."""
    point = Points(query[None, :], None)
    best = Best(k, float(point.squared[0]), largest, floor)
    computed = 0
    queue = [(max(abs(to_region - p.parent) - p.radius, 0.0), i, -1.0) for i, p in enumerate(pages)]
    heapq.heapify(queue)
    while queue:
        bound, i, d = heapq.heappop(queue)
        reach = best.reach()
        if bound > reach:
            break
        page = pages[i]
        if d < 0:
            d = float(point.distances(page.centre)[0, 0])
            computed += 1
            heapq.heappush(queue, (max(bound, d - page.radius), i, d))
            continue
        low = np.searchsorted(page.distance, d - reach)
        high = np.searchsorted(page.distance, d + reach, "right")
        ids = page.ids[low:high]
        if len(ids):
            score = dots(point.v, page.vectors[low:high])[0]
            computed += len(ids)
            other = ids != own
            best.add(score[other], ids[other])
    return best, computed


# -- the tree ------------------------------------------------------------------------

def _whole(vector: Column, scale: int) -> Column:
    """Scaled whole numbers, or null where the vector takes no part."""
    x = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    small_enough = F.forall(x, lambda c: F.abs(c * scale) < float(2 * LARGEST))
    whole = F.when(small_enough, F.transform(x, lambda c: F.floor(c * scale).cast("int"))).otherwise(
        F.raise_error(F.lit(f"a scaled component is {LARGEST} or more")))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & finite, whole)


class Tree:
    """A written M-tree over a table of vectors."""

    def __init__(self, rows: DataFrame, k: int, region_rows: int, max_regions: int, block_bytes: int, page_rows: int):
        """``rows``: vec_id, v (whole numbers), dim, k1, k2, each distinct."""
        # Of equal vectors the least ids; Spark limits each group before it is shuffled.
        copies = Window.partitionBy("k1", "k2").orderBy("vec_id")
        kept = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
        entries = written(kept.select("vec_id", "v", "dim", "k1", "k2", "copy"), "mtree-entries")
        size = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x)
        total = entries.agg(F.max(size).alias("largest"), F.count(F.lit(1)).alias("n")).first()
        self.largest, n = total["largest"] or 0, total["n"]
        self.k, self.page_rows = k, page_rows
        self.centres = self._routing_objects(entries, min(max_regions, -(-n // region_rows)), n)
        placed = written(self._placed(entries), "mtree-placed")
        forget(entries)
        #: dim, region, radius, blocks: a row for each routing object.
        block_rows = F.greatest(F.lit(1), F.floor(F.lit(block_bytes) / (F.col("dim") * 8)))
        self.regions = written(placed.groupBy("dim", "region").agg(
            F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")).select(
                "dim", "region", "radius", F.ceil(F.col("n") / block_rows).alias("blocks")), "mtree-regions")
        dealt = placed.join(small(self.regions.select("dim", "region", "blocks")), ["dim", "region"]).withColumn(
            "block", F.pmod(F.xxhash64("vec_id", "k1", "k2"), "blocks"))
        self.pages = written(self._pages(dealt), "mtree-pages")
        forget(placed)

    def _routing_objects(self, entries: DataFrame, regions: int, n: int) -> dict[int, Points]:
        """By length of the vectors: a fixed random sample, ``regions`` in all or so."""
        if regions < 2:
            return {}
        spread = F.shiftrightunsigned(F.xxhash64(F.lit(11), "k1", "k2"), 11) / float(2**53)
        rows = entries.where((F.col("copy") == 1) & (spread < F.lit(regions / n))).select("dim", "v").limit(
            2 * regions + 100).collect()
        by_dim: dict[int, list] = {}
        for r in rows:
            by_dim.setdefault(r["dim"], []).append(r["v"])
        return {dim: Points(_matrix(sorted(v)), self.largest) for dim, v in by_dim.items()}

    def _placed(self, entries: DataFrame) -> DataFrame:
        """Each vector's region and its distance to the region's object."""
        centres, largest = self.centres, self.largest

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for dim, group in batch.groupby("dim"):
                    points = Points(_matrix(group["v"]), largest)
                    objects, first = (centres[dim], 0) if dim in centres else (_origin(dim), -1)
                    region, distance = np.zeros(len(group), int), np.zeros(len(group))
                    for at, part in _strips(points):
                        d = part.distances(objects)
                        region[at:at + len(d)], distance[at:at + len(d)] = d.argmin(1) + first, d.min(1)
                    yield group.assign(region=region, distance=distance)

        columns = "vec_id", "v", "dim", "k1", "k2"
        return entries.select(*columns).mapInPandas(
            run, "vec_id long, v array<int>, dim int, k1 long, k2 long, region int, distance double")

    def _pages(self, dealt: DataFrame) -> DataFrame:
        largest, page_rows, centres = self.largest, self.page_rows, self.centres

        def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            dim, region, block = map(int, key)
            routing = centres[dim].take([region]) if region >= 0 else _origin(dim)
            pages = build_pages(group["vec_id"].to_numpy(np.int64), Points(_matrix(group["v"]), largest), routing,
                                page_rows)
            return pd.DataFrame([(dim, region, block, p.centre.v.astype(np.int32).tobytes(), p.radius, p.parent,
                                  p.ids.tobytes(), p.vectors.astype(np.int32).tobytes(), p.distance.tobytes())
                                 for p in pages], columns=columns)

        columns = ["dim", "region", "block", "centre", "radius", "parent", "ids", "vectors", "distances"]
        return dealt.select("dim", "region", "block", "vec_id", "v").groupBy("dim", "region", "block").applyInPandas(
            build, "dim int, region int, block long, centre binary, radius double, parent double, ids binary, "
                   "vectors binary, distances binary")

    # -- search ----------------------------------------------------------------------

    def _visits(self, queries: DataFrame, radius: dict, first: int, last: int | None) -> DataFrame:
        """The regions of each query from its ``first`` to before its ``last`` by
        lower bound, as far as they may hold one of its best."""
        centres, largest = self.centres, self.largest

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for dim, group in batch.groupby("dim"):
                    points = Points(_matrix(group["v"]), None)
                    floors = [None if f == NO_FLOOR else int(f) for f in group["floor"]]
                    if dim in centres:
                        near = radius.get(dim, {})
                        used = np.array(sorted(near))
                        reach_of, objects = np.array([near[r] for r in used]), centres[dim].take(used)
                    else:
                        used, reach_of, objects = np.array([-1]), np.array([np.inf]), _origin(dim)
                    for at, part in _strips(points, 256):
                        d = part.distances(objects)
                        low = np.maximum(d - reach_of, 0)
                        row, region, to = [], [], []
                        for i in range(len(d)):
                            turn = np.lexsort((d[i], low[i]))[first:last]
                            best = Best(1, float(part.squared[i]), largest, floors[at + i])
                            turn = turn[low[i][turn] <= best.reach()]
                            row += [at + i] * len(turn)
                            region += used[turn].tolist()
                            to += d[i][turn].tolist()
                        yield group.iloc[row].assign(region=region, distance=to)

        return queries.select("query_id", "k1", "k2", "v", "dim", "floor").mapInPandas(
            run, "query_id long, k1 long, k2 long, v array<int>, dim int, floor long, region int, distance double")

    def _found(self, visits: DataFrame, query_slice: int) -> DataFrame:
        """The best of every block visited for each of its queries."""
        load = written(visits.groupBy("dim", "region").agg(
            F.ceil(F.count(F.lit(1)) / query_slice).alias("slices")).join(self.regions, ["dim", "region"]).select(
                "dim", "region", "slices", "blocks"), "mtree-load")
        key = ["dim", "region", "block", "slice"]
        asked = visits.join(small(load), ["dim", "region"]).withColumn(
            "slice", F.pmod(F.xxhash64("query_id", "k1", "k2"), "slices")).withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        pages = self.pages.join(small(load.select("dim", "region", "slices")), ["dim", "region"]).withColumn(
            "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
        k, largest = self.k, self.largest

        def run(group: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            held, dim = [], int(group[0])
            for p in right.itertuples(index=False) if len(left) else ():
                centre = np.frombuffer(p.centre, np.int32).astype(np.int64)[None, :]
                held.append(Page(Points(centre, largest), p.radius, p.parent, np.frombuffer(p.ids, np.int64),
                                 np.frombuffer(p.vectors, np.int32).reshape(-1, dim).astype(np.int64),
                                 np.frombuffer(p.distances, np.float64)))
            out: list[tuple[np.ndarray, ...]] = []
            for q in left.itertuples(index=False):
                best, _ = search_block(held, np.asarray(q.v, np.int64), q.query_id, q.distance, k, largest,
                                       None if q.floor == NO_FLOOR else q.floor)
                n = len(best.ids)
                out.append((np.full(n, q.query_id), np.full(n, q.k1), np.full(n, q.k2), best.ids, best.score))
            parts = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
            return pd.DataFrame(dict(zip(["query_id", "k1", "k2", "vec_id", "score"], parts, strict=True)))

        return asked.select(*key, "query_id", "k1", "k2", "v", "floor", "distance").groupBy(*key).cogroup(
            pages.drop("slices").groupBy(*key)).applyInPandas(
                run, "query_id long, k1 long, k2 long, vec_id long, score long")

    def search(self, queries: DataFrame, rounds: tuple[int, ...] = (1, 8), query_slice: int = 4096) -> DataFrame:
        """query_id, k1, k2, rank, vec_id, score of the best of each query of a
        written table (query_id, k1, k2, v, dim): after each round of so many
        regions the k-th best bounds the next; a last round has all the rest."""
        radius: dict[int, dict[int, float]] = {}
        for r in self.regions.where("region >= 0").collect():  # a row for each routing object
            radius.setdefault(r["dim"], {})[r["region"]] = r["radius"]
        most = max([1, *map(len, radius.values())])
        ends = [e for e in np.cumsum(rounds).tolist() if e < most]
        best: DataFrame | None = None
        for first, last in zip([0, *ends], [*ends, None]):
            asked = queries.withColumn("floor", F.lit(NO_FLOOR))
            if best is not None:
                floors = best.where(F.col("rank") == self.k).select("query_id", "k1", "k2", F.col("score").alias("floor"))
                asked = queries.join(floors, ["query_id", "k1", "k2"], "left").fillna({"floor": NO_FLOOR})
            visits = written(self._visits(asked, radius, first, last), "mtree-visits")
            found = written(self._found(visits, query_slice), "mtree-found")
            forget(visits)
            rows = found if best is None else best.drop("rank").unionByName(found)
            turn = Window.partitionBy("query_id", "k1", "k2").orderBy(F.col("score").desc(), "vec_id")
            best = written(rows.withColumn("rank", F.row_number().over(turn)).where(F.col("rank") <= self.k),
                           "mtree-best")
            forget(found)
        return best


def top_k(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 10, scale: int = 1024,
          region_rows: int = 4096, max_regions: int = 1024, block_bytes: int = 4 << 20, page_rows: int = 256,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each
    row whose id ``is_query`` picks with all rows of other ids."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), _whole(F.col(vector_col), scale).alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(7), "v"))
    distinct = written(rows.groupBy("vec_id", "k1", "k2").agg(F.first("v").alias("v")).withColumn(
        "dim", F.size("v")), "mtree-rows")
    tree = Tree(distinct, k, region_rows, max_regions, block_bytes, page_rows)
    queries = written(distinct.where(is_query(F.col("vec_id"))).withColumnRenamed("vec_id", "query_id"), "mtree-queries")
    best = tree.search(queries)
    for t in (distinct, queries, tree.pages):
        forget(t)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
