"""Join, aggregation, ranking and profile operators on small hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.operators import (anti, anti_by_outer_join, attr, best_in_group,
                              blank_null_breakdown, broadcast_if_small, count_best, daily_rate,
                              dedupe_join, duplicate_keys, estimated_bytes, fanout,
                              orphan_keys, page, per_month, period_daily_rates, profile_table,
                              representative, semi, spread, top_k, with_total)


@pytest.fixture(scope="module")
def dup(spark):
    left = spark.createDataFrame([("k", i) for i in range(3)] + [("lonely_l", 9), (None, 8)], "k string, v int")
    right = spark.createDataFrame([("k", i) for i in range(4)] + [("lonely_r", 7), (None, 6)], "k string, v int")
    return left, right


def test_fanout_equals_join_rows(dup):
    left, right = dup
    f = fanout(left, right, "k", "k").collect()
    assert [(r.key, r.n_left, r.n_right, r.n_pairs) for r in f] == [("k", 3, 4, 12)]
    assert left.join(right.withColumnRenamed("v", "w"), "k").count() == sum(r.n_pairs for r in f)


def test_dedupe_join_does_not_multiply(dup):
    left, right = dup
    assert dedupe_join(left, right, "k").count() == 1
    assert dedupe_join(left, right, "k", "left").count() == 3  # k, lonely_l, NULL


def test_semi_and_anti_forms_agree(dup):
    left, right = dup
    assert sorted(r.v for r in semi(left, right, "k").collect()) == [0, 1, 2]
    a1 = sorted(r.v for r in anti(left, right, "k").collect())
    a2 = sorted(r.v for r in anti_by_outer_join(left, right, "k", "k", "left").collect())
    a3 = sorted(r.v for r in anti_by_outer_join(left, right, "k", "k", "right").collect())
    assert a1 == a2 == a3 == [8, 9]  # NULL key is kept: NOT EXISTS, not NOT IN


def test_orphans_both_directions(dup):
    left, right = dup
    got = {(r.only_in, r.key, r.n_rows) for r in orphan_keys(left, right, "k", "k").collect()}
    assert got == {("left", "lonely_l", 1), ("right", "lonely_r", 1), ("left", None, 1), ("right", None, 1)}


def test_duplicate_keys(dup):
    left, _ = dup
    assert [(r.k, r.n_rows) for r in duplicate_keys(left, ["k"]).collect()] == [("k", 3)]


def test_broadcast_only_when_small(spark):
    small = spark.range(10)
    assert estimated_bytes(small) is not None
    hinted = broadcast_if_small(small, max_bytes=1 << 20)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    not_hinted = broadcast_if_small(small, max_bytes=1)
    assert "broadcast" not in not_hinted._jdf.queryExecution().analyzed().toString().lower()


def test_attr_and_representative(spark):
    df = spark.createDataFrame([(1, "a", 2, 10), (1, "a", 1, 20), (1, "a", 1, 5), (2, "a", 1, 1), (2, "b", 2, 2),
                                (3, None, 1, 3), (3, "c", 2, 4)], "g int, s string, o int, v int")
    out = {r.g: (r.a, r.rep) for r in df.groupBy("g").agg(attr("s").alias("a"),
                                                          representative("v", "o").alias("rep")).collect()}
    assert out == {1: ("a", 5), 2: (None, 1), 3: (None, 3)}


def test_spread_population_vs_sample(spark):
    df = spark.createDataFrame([(1, float(x)) for x in (2, 4, 4, 4, 5, 5, 7, 9)], "g int, x double")
    r = df.groupBy("g").agg(*spread("x", "x", median_exact=True)).first()
    assert r.x_avg == 5.0 and r.x_median == 4.5
    assert r.x_std_pop == pytest.approx(2.0) and r.x_cv == pytest.approx(0.4)
    assert r.x_std_samp == pytest.approx(2.138089935)
    approx = df.groupBy("g").agg(*spread("x", "x")).first()
    assert approx.x_median in (4.0, 5.0)  # the sketch returns an observed value


def test_daily_rate_and_period_pivot(spark):
    rows = [("s1", dt.datetime(2004, 11, d), 100) for d in (1, 1, 2, 3)] + \
           [("s1", dt.datetime(2004, 12, d), 50) for d in (5, 6)] + \
           [("s1", dt.datetime(2005, 11, 1), 70), ("s2", dt.datetime(2004, 12, 24), 30)]
    df = spark.createDataFrame(rows, "store string, ts timestamp_ntz, cents long")
    monthly = per_month(df, ["store"], "ts", {"amount": "cents"})
    rate = {r.store: (r.num_days, r.revenue, r.daily_revenue)
            for r in daily_rate(monthly, ["store"], unit_scale=100).collect()}
    assert {k: v[:2] for k, v in rate.items()} == {"s1": (6, 570), "s2": (1, 30)}
    assert rate["s1"][2] == pytest.approx(0.95) and rate["s2"][2] == pytest.approx(0.3)
    wide = {r.store: r for r in period_daily_rates(monthly, ["store"], "month", {"nov": 11, "dec": 12}).collect()}
    assert (wide["s1"].nov_sales, wide["s1"].nov_days, wide["s1"].dec_days) == (470, 4, 2)
    assert (wide["s2"].nov_sales, wide["s2"].nov_days) == (None, 0)
    assert daily_rate(monthly, ["store"], min_days=2).count() == 1


def test_best_in_group_keeps_ties_and_counts(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, 10.0), (1, 3, 5.0), (2, 1, 1.0), (2, 3, 9.0)],
                               "store int, month int, rev double")
    best = best_in_group(df, ["store"], [F.desc("rev")]).collect()
    assert sorted((r.store, r.month) for r in best) == [(1, 1), (1, 2), (2, 3)]
    counts = {r.month: r.n_groups for r in count_best(df, ["store"], "month", [F.desc("rev")]).collect()}
    assert counts == {1: 1, 2: 1, 3: 1}
    worst = best_in_group(df, ["store"], [F.asc("rev")]).collect()
    assert sorted((r.store, r.month) for r in worst) == [(1, 3), (2, 1)]


def test_top_k_and_page(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    assert [r.id for r in top_k(df, 3, [F.desc("id")]).collect()] == [99, 98, 97]
    assert [r.id for r in page(df, [F.col("id")], offset=5, n=10).collect()] == list(range(5, 15))


def test_with_total_rollup(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    out = {(r.k, r.is_total): r.s for r in with_total(df, ["k"], [F.sum("v").alias("s")]).collect()}
    assert out == {("a", 0): 3, ("b", 0): 3, (None, 0): 4, (None, 1): 10}


def test_profile_and_blanks(spark):
    df = spark.createDataFrame([(1, "x"), (2, ""), (3, None), (3, "x")], "id int, category string")
    prof = {r.column_name: (r.n_rows, r.n_nulls, r.n_non_null, r.n_distinct)
            for r in profile_table(df).collect()}
    assert prof == {"id": (4, 0, 4, 3), "category": (4, 1, 3, 2)}
    approx = {r.column_name: r.n_distinct for r in profile_table(df, exact=False).collect()}
    assert approx == {"id": 3, "category": 2}
    typed = {r.column_name: r.data_type for r in profile_table(df, with_types=True).collect()}
    assert typed == {"id": "int", "category": "string"}
    kinds = {r.kind: r.n_rows for r in blank_null_breakdown(df, "category").collect()}
    assert kinds == {"nothing": 1, "blank": 1, "value": 2}


def test_unqualified_shared_column_is_ambiguous(spark):
    """A column name both sides share must be qualified through a table alias."""
    from pyspark.errors import AnalysisException
    a = spark.createDataFrame([(1, "x")], "k int, v string").alias("a")
    b = spark.createDataFrame([(1, "y")], "k int, v string").alias("b")
    j = a.join(b, F.col("a.k") == F.col("b.k"))
    with pytest.raises(AnalysisException):
        j.select("v").collect()
    assert j.select(F.col("a.v"), F.col("b.v")).first() == ("x", "y")


def test_derived_table_inner_alias_not_visible_outside(spark):
    """Names inside a derived table are only what it selects."""
    from pyspark.errors import AnalysisException
    spark.createDataFrame([(1, 2)], "k int, v int").createOrReplaceTempView("t_scope")
    with pytest.raises(AnalysisException):
        spark.sql("SELECT inner_t.v FROM (SELECT k FROM t_scope AS inner_t) AS sub").collect()
    assert spark.sql("SELECT sub.k FROM (SELECT k FROM t_scope) AS sub").first()[0] == 1
