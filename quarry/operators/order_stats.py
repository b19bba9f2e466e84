"""Exact order statistics in bounded memory (A22, D11) and deep pages.

``exact_quantiles`` finds, for every group, the value at given ranks of a
continuous column.  A sort by group would put a group that holds a third of all
rows into one task, and Spark's exact percentile keeps a group's values in one
map.  Here a wanted rank is closed in by histograms: a round takes approximate
quantiles of the rows still in question as edges, counts *exactly* how many of
them lie at and between the edges, and keeps the one cell that holds the rank.
A cell is an edge value itself, which ends the search, or the open interval
between two; so a value that most rows share ends it at once, and otherwise some
thirtieth of the rows remain.  Edges only steer: counts decide, so the result is
exact.  All rounds are group-bys with partial aggregation; states of a group
(edges, counts of at most ``2 * EDGES + 1`` cells) are of fixed size.

``page_of`` answers ``LIMIT n OFFSET m`` without sorting the rows before the
page: it selects the sort column's values at both ends of the page in the same
way, reads the rows between them and sorts only these.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.joins import broadcast_if_small
from quarry.session import kept

EDGES = 32         # cells' edges of a round
FEW_ROWS = 2_000   # rows of a cell that are sorted in one group


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Join on columns that may hold NULL, as groups do."""
    other = right.select(*[F.col(n).alias(f"_{n}") for n in names], *[c for c in right.columns if c not in names])
    cond = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names])
    return left.join(broadcast_if_small(other), cond).drop(*[f"_{n}" for n in names])


def _cells(rows: DataFrame, tags: Sequence[str]) -> DataFrame:
    """tags, low, high, held, before: the non-empty cells of each tag's values ``x``.

    A cell with ``low = high`` is that value; others are open intervals, with
    NULL for no bound.  ``held`` rows lie in it and ``before`` in lower cells."""
    share = F.array(*[F.lit(i / (EDGES - 1)) for i in range(EDGES)])
    # The least and the largest are edges too: a round settles these at least.
    edges = kept(rows.groupBy(*tags).agg(F.sort_array(F.array_distinct(F.concat(
        F.percentile_approx("x", share, F.lit(1000)), F.array(F.min("x"), F.max("x"))))).alias("edges")), "order-edges")
    below = F.size(F.filter("edges", lambda e: e < F.col("x")))
    at = F.array_contains("edges", F.col("x"))
    placed = _same(rows, edges, tags).withColumn("cell", 2 * below + at.cast("int"))
    counted = placed.groupBy(*tags, "cell").agg(F.count(F.lit(1)).alias("held"), F.first("edges").alias("edges"))
    lower = Window.partitionBy(*tags).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    place = F.floor(F.col("cell") / 2).cast("int")
    on_edge = F.col("cell") % 2 == 1

    def edge(i: Column) -> Column:
        return F.when((i >= 0) & (i < F.size("edges")), F.get("edges", i))

    return counted.select(
        *tags, F.when(on_edge, edge(place)).otherwise(edge(place - 1)).alias("low"), edge(place).alias("high"), "held",
        F.coalesce(F.sum("held").over(lower), F.lit(0)).alias("before"))


def _inside() -> Column:
    x = F.col("x")
    return (F.col("low").isNull() | (x > F.col("low"))) & (F.col("high").isNull() | (x < F.col("high")))


def values_at(rows: DataFrame, keys: Sequence[str], ranks: DataFrame, few_rows: int = FEW_ROWS) -> DataFrame:
    """keys, rank, value: the value of ``x`` at each rank (from 1) of its group.

    ``rows``: keys and ``x``, without NULL or NaN in ``x``; ``ranks``: keys and
    rank, distinct, within the group's number of rows."""
    if not keys:  # one group of all rows
        found = values_at(rows.withColumn("_all", F.lit(0)), ["_all"], ranks.withColumn("_all", F.lit(0)), few_rows)
        return found.drop("_all")
    names = [*keys, "rank"]
    first = kept(_cells(rows, keys), "order-cells")
    unbounded = F.lit(None).cast(rows.schema["x"].dataType)
    state = _same(ranks.withColumn("left", F.col("rank")), first, keys).withColumns(
        {"from": unbounded, "to": unbounded})
    done: list[DataFrame] = []
    while True:
        state = kept(state.where((F.col("left") > F.col("before")) & (F.col("left") <= F.col("before") + F.col("held")))
                      .select(*names, (F.col("left") - F.col("before")).alias("left"),
                              F.coalesce("low", "from").alias("low"), F.coalesce("high", "to").alias("high"), "held"),
                      "order-state")
        exact = F.coalesce(F.col("low") == F.col("high"), F.lit(False))
        done.append(state.where(exact).select(*names, F.col("low").alias("value")))
        some = state.where(~exact & (F.col("held") <= few_rows))
        candidates = _same(rows, some, keys).where(_inside())
        done.append(candidates.groupBy(*names).agg(  # at most few_rows values a group
            F.sort_array(F.collect_list("x")).alias("values"), F.first("left").alias("left")).select(
                *names, F.element_at("values", F.col("left").cast("int")).alias("value")))
        many = state.where(~exact & (F.col("held") > few_rows))
        if many.isEmpty():
            return reduce(DataFrame.unionByName, done)
        # Each rank's rows in question, by its own number: a row may lie in several intervals.
        within = _same(rows, many, keys).where(_inside()).select(*names, "x")
        state = _same(many.select(*names, "left", F.col("low").alias("from"), F.col("high").alias("to")),
                      kept(_cells(within, names), "order-cells"), names)


def exact_quantiles(df: DataFrame, keys: Sequence[str], column: str, shares: Sequence[float],
                    few_rows: int = FEW_ROWS) -> DataFrame:
    """keys, share, value: the least value that at least that share of the
    group's values do not exceed (``quantile_disc``); NULL and NaN are no values."""
    x = F.col(column)
    rows = df.select(*keys, x.alias("x")).where(x.isNotNull() & ~F.isnan(x.cast("double")))
    share = F.array(*[F.lit(float(s)) for s in shares])
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    wanted = kept(n.select(*keys, "n", F.explode(share).alias("share")).withColumn(
        "rank", F.greatest(F.lit(1), F.ceil(F.col("share") * F.col("n"))).cast("long")), "order-ranks")
    found = values_at(rows, keys, wanted.select(*keys, "rank").distinct(), few_rows)
    names = [*keys, "rank"]
    return _same(wanted.select(*names, "share"), found, names).select(*keys, "share", "value")


# -- pages -----------------------------------------------------------------------------

def page_of(df: DataFrame, order: Sequence[str], offset: int, n: int, few_rows: int = 10_000) -> DataFrame:
    """Rows ``offset`` to ``offset + n`` by ascending ``order`` columns (numbers,
    dates or times; NULL first), as ORDER BY with LIMIT and OFFSET gives them.

    Few rows in question are sorted as Spark does.  Of more, those below the
    page's first value are counted, those above its last are never looked at
    again, and where a value that many share crosses an end of the page, its
    rows are paged by the remaining columns."""
    if n <= 0:
        return df.limit(0)
    column = order[0] if order else None
    totals = df.agg(F.count(F.lit(1)).alias("n"), F.count(column if column else F.lit(1)).alias("known")).first()
    total, nulls = totals["n"], totals["n"] - totals["known"]
    if offset >= total:
        return df.limit(0)
    if not order:  # rows tied in all columns: any of them
        return df.offset(offset).limit(n)
    if total <= few_rows:
        return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).offset(offset).limit(n)
    c, rest, stop = F.col(column), list(order[1:]), min(offset + n, total)
    parts: list[DataFrame] = []
    if offset < nulls:  # the page begins among the NULLs, which come first
        parts.append(page_of(df.where(c.isNull()), rest, offset, min(stop, nulls) - offset, few_rows))
    if stop > nulls:
        known, kind = df.where(c.isNotNull()), df.schema[column].dataType.simpleString()
        begin, end = max(offset, nulls) - nulls, stop - nulls
        ranks = df.sparkSession.createDataFrame(sorted({(begin + 1,), (end,)}), "rank long")
        at = {r["rank"]: r["value"] for r in  # one or two values
              values_at(known.select(_number(c, kind).alias("x")), [], ranks).collect()}
        low, high = (_literal(at[r], kind) for r in (begin + 1, end))
        for value in [low] if at[begin + 1] == at[end] else [low, high]:
            less, same = known.agg(F.count_if(c < value), F.count_if(c == value)).first()
            first = max(begin - less, 0)
            parts.append(page_of(known.where(c == value), rest, first, min(end - less, same) - first, few_rows))
        if at[begin + 1] != at[end]:  # all rows between are on the page
            parts.append(known.where((c > low) & (c < high)))
    return reduce(DataFrame.unionByName, parts).orderBy(*[F.col(o).asc_nulls_first() for o in order])


_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _number(c: Column, kind: str) -> Column:
    """A sort column as a number of the same order."""
    if kind == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), c)
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "date":
        return F.unix_date(c)
    if kind == "string":
        raise TypeError("pages are cut by numbers, dates or times")
    return c


def _literal(value, kind: str) -> Column:
    """The value of a sort column that has this number."""
    if kind == "timestamp_ntz":
        return F.timestamp_add("MICROSECOND", F.lit(value), F.expr(_EPOCH))
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(value))
    if kind == "date":
        return F.date_from_unix_date(F.lit(value))
    return F.lit(value).cast(kind)
