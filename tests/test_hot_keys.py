import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators.hot_keys import exploded_join, hot_grids
from quarry.plans import QUERIES
from quarry.sources import Tables, export_folder
from tools.skew_drill import derive


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(3)
    left = [(rng.choice([1, 1, 1, 2, 3, None, 50 + rng.randrange(40)]), "same") for _ in range(900)]
    right = [(rng.choice([1, 1, 2, 4, None, 50 + rng.randrange(60)]), rng.randrange(5)) for _ in range(300)]
    right += [(4, 9)] * 200  # hot on the right alone
    return (spark.createDataFrame(left, "k long, name string").repartition(4),
            spark.createDataFrame(right, "rk long, w long").repartition(4), left, right)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("target", [10, 100, 1_000_000])
def test_all_rows_and_no_others(sides, how, target):
    a, b, left, right = sides
    want = Counter()
    for k, name in left:
        matches = [(rk, w) for rk, w in right if rk is not None and rk == k]
        for m in matches or ([(None, None)] if how == "left" else []):
            want[k, name, *m] += 1
    got = Counter(map(tuple, exploded_join(a, b, "k", "rk", how, target).collect()))
    assert got == want


def test_grids_bound_their_cells(sides):
    a, b, _, _ = sides
    grids = {r["key"]: r for r in hot_grids(a, b, "k", "rk", 100).collect()}
    assert 1 in grids and None not in grids
    for r in grids.values():
        assert r["rows_of"] <= r["n_left"] and r["n_left"] / r["rows_of"] <= 100
        if r["n_right"]:
            assert r["n_right"] / r["columns_of"] <= 100
            assert r["n_left"] * r["n_right"] / (r["rows_of"] * r["columns_of"]) <= 100
    assert hot_grids(a, b, "k", "rk", 10**9).count() == 0


def test_other_joins_are_refused(sides):
    with pytest.raises(ValueError):
        exploded_join(sides[0], sides[1], "k", "rk", "full")


def test_hot_user_is_dealt_over_tasks(spark, sf_small):
    out = export_folder(spark, "skewed-tables")
    derive(spark, sf_small, out)
    df = QUERIES["events_orders_exploded"](spark, out, target_rows=200)
    t = Tables(spark, out)
    plain = t.events.join(t.orders, F.col("user_id") == F.col("o_custkey"), "left").select(
        "event_id", "user_id", "o_orderkey")
    assert Counter(map(tuple, df.collect())) == Counter(map(tuple, plain.collect()))
    # The pairs of the hot user alone, by the cell they were made in.
    hot = plain.groupBy("user_id").count().orderBy(F.desc("count")).first()
    grid = hot_grids(t.events.select("user_id"), t.orders.select("o_custkey"), "user_id", "o_custkey", 200).where(
        F.col("key") == hot["user_id"]).first()
    assert grid["rows_of"] * grid["columns_of"] >= hot["count"] / 200


def test_no_task_has_twice_the_median(spark, sf_small):
    out = export_folder(spark, "skewed-tables")
    derive(spark, sf_small, out)
    t = Tables(spark, out)
    left, right = t.events.select("event_id", "user_id"), t.orders.select("o_custkey", "o_orderkey")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)

        def rows_a_task(df):
            n = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
            return n[-1], n[len(n) // 2]

        plain = left.join(right, F.col("user_id") == F.col("o_custkey"))
        most, median = rows_a_task(plain)
        assert most > 2 * median  # the hot user's rows are one task's
        most, median = rows_a_task(exploded_join(left, right, "user_id", "o_custkey", "inner", 25))
        assert most <= 2 * median
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
