import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import order_stats as O
from quarry.plans import QUERIES
from quarry.sources import Tables


def quantile(values, share):
    values = sorted(values)
    return values[max(1, math.ceil(share * len(values))) - 1]


def shapes(rng):
    return {
        "hot": [rng.gauss(0, 1) for _ in range(4000)],                      # a third of all rows and more
        "one value": [7.25] * 900,
        "mostly one": [1.5] * 700 + [rng.random() for _ in range(200)],
        "outliers": [rng.random() for _ in range(600)] + [1e300, -1e300, 1e-300, -0.0, 0.0],
        "steps": [float(rng.randrange(5)) for _ in range(800)],
        "few": [3.0, 1.0, 2.0], "single": [5.0],
        "wide": [math.copysign(math.exp(rng.uniform(-600, 600)), rng.random() - 0.5) for _ in range(900)],
    }


def test_every_shape_against_sorting(spark, monkeypatch):
    monkeypatch.setattr(O, "EDGES", 5)
    groups = shapes(random.Random(1))
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("hot", None), ("none", None), ("hot", float("nan"))]
    rows += [(None, float(i)) for i in range(11)]
    random.Random(2).shuffle(rows)
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {(r["g"], r["share"]): r["value"] for r in O.exact_quantiles(df, ["g"], "v", shares, few_rows=20).collect()}
    groups[None] = [float(i) for i in range(11)]
    assert got == {(g, s): quantile(vs, s) for g, vs in groups.items() for s in shares}


def test_whole_numbers_without_groups(spark):
    values = [2**62 + i for i in range(50)] + [-(2**62) - i for i in range(60)] + list(range(100))
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = {r["share"]: r["value"] for r in O.exact_quantiles(df, [], "v", [0.1, 0.5, 0.9], few_rows=4).collect()}
    assert got == {s: quantile(values, s) for s in (0.1, 0.5, 0.9)}


def test_empty_table(spark):
    assert O.exact_quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", [0.5]).collect() == []


def test_report_in_rounds_equals_sorting(spark, sf_small):
    fact = Tables(spark, sf_small).lineitem
    got = {(r["l_returnflag"], r["share"]): r["value"] for r in
           O.exact_quantiles(fact, ["l_returnflag"], "l_extendedprice", [0.25, 0.5], few_rows=10).collect()}
    values = {}
    for r in fact.select("l_returnflag", "l_extendedprice").collect():
        values.setdefault(r[0], []).append(r[1])
    assert got == {(g, s): quantile(v, s) for g, v in values.items() for s in (0.25, 0.5)}


# -- pages

def by_sorting(df, order, offset, n):
    return [tuple(r) for r in df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).offset(offset).limit(n).collect()]


@pytest.fixture(scope="module")
def ties(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([None, 0.5, 0.5, -1.0, 2.0]), i) for i in range(600)]
    return spark.createDataFrame(rows, "a int, b double, id long").repartition(5).withColumn(
        "ts", F.expr("timestampadd(SECOND, coalesce(a, 0) * 1000 + cast(id div 7 as int), timestamp_ntz'2024-01-01 00:00:00')"))


@pytest.mark.parametrize("offset, n", [(95, 20), (300, 1), (590, 50), (600, 5), (50, 0), (120, 333)])
def test_pages_with_ties_and_nulls(ties, offset, n):
    for order in (["a", "b", "id"], ["ts", "id"]):
        got = [tuple(r) for r in O.page_of(ties, order, offset, n, few_rows=30).collect()]
        assert got == by_sorting(ties, order, offset, n)


def test_days_and_strings(spark, ties):
    days = ties.withColumn("day", F.to_date("ts")).select("day", "id")
    assert [tuple(r) for r in O.page_of(days, ["day", "id"], 200, 9, few_rows=5).collect()] == by_sorting(
        days, ["day", "id"], 200, 9)
    with pytest.raises(TypeError):
        O.page_of(ties.withColumn("s", F.lit("x")), ["s"], 200, 9, few_rows=5)


def test_a_deep_page_sorts_no_prefix(spark, sf_small):
    df = QUERIES["lines_page_500"](spark, sf_small, few_rows=500)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 10
    # What is sorted is what lies between the page's ends, by pushed filters.
    assert "Filter" in plan and "4990" not in plan
