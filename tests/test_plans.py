"""Plan-shape guarantees that matter at scale, checked on the physical plans."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import daily_rate, fanout, per_month, semi
from quarry.plans import QUERIES


# Reports that count distinct days must not expand fact rows per distinct expression.
DAY_COUNTING = ["best_month_per_supplier", "worst_month_per_supplier", "returns_month_per_supplier",
                "avg_daily_revenue_supplier_month", "avg_daily_revenue_per_month", "sales_by_income_band",
                "income_extremes", "conditional_pivot_months", "rise_nov_dec_supplier", "rise_nov_dec_dept",
                "fall_aug_sep_supplier", "fall_aug_sep_quantity", "distinct_days_per_month",
                "supplier_month_days", "supplier_month_few_days", "rise_nov_dec_part"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop(spark, sf_small, name):
    plan = _plan(QUERIES[name](spark, sf_small))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", DAY_COUNTING)
def test_day_counts_without_expand(spark, sf_small, name):
    plan = _plan(QUERIES[name](spark, sf_small))
    assert "Expand" not in plan


def test_purchase_filters_reach_the_scan(spark, sf_small):
    text = _formatted(QUERIES["best_month_per_supplier"](spark, sf_small))
    assert "Not(EqualTo(l_returnflag,R))" in text
    assert "Or(LessThan(l_shipdate," in text  # the excluded month, as a pushable range
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_returnflag:string,l_shipdate" in text


def test_rank_filter_becomes_group_limit(spark, sf_small):
    assert "WindowGroupLimit" in _plan(QUERIES["best_month_per_supplier"](spark, sf_small))


def test_top_k_is_take_ordered(spark, sf_small):
    assert "TakeOrderedAndProject" in _plan(QUERIES["topk_first_orders"](spark, sf_small))


def test_small_dimensions_are_broadcast(spark, sf_small):
    plan = _plan(QUERIES["join_star_four"](spark, sf_small))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 4


# ------------------------------------------------------------------ a hot key, brute force

@pytest.fixture(scope="module")
def hot(spark):
    """One store holding a third of all rows, plus a long tail."""
    import datetime as dt
    rows = []
    for i in range(600):
        store = "HOT" if i % 3 == 0 else f"s{i % 37}"
        rows.append((store, dt.datetime(2004, 1 + i % 12, 1 + (i * 7) % 28), 100 + i))
    return spark.createDataFrame(rows, "store string, ts timestamp_ntz, cents long")


def test_hot_key_daily_rate_matches_brute_force(spark, hot):
    got = {r.store: (r.num_days, r.revenue) for r in
           daily_rate(per_month(hot, ["store"], "ts", {"amount": "cents"}), ["store"]).collect()}
    want = {r.store: (r.d, r.s) for r in hot.groupBy("store").agg(
        F.countDistinct(F.to_date("ts")).alias("d"), F.sum("cents").alias("s")).collect()}
    assert got == want
    assert got["HOT"][1] == sum(100 + i for i in range(0, 600, 3))


def test_hot_key_fanout_and_semi(spark, hot):
    other = hot.select("store").withColumnRenamed("store", "k")
    f = {r.key: r.n_pairs for r in fanout(hot, other, "store", "k").collect()}
    assert f["HOT"] == 200 * 200
    assert sum(f.values()) == hot.join(other, hot["store"] == other["k"]).count()
    assert semi(hot, other.withColumnRenamed("k", "store"), "store").count() == hot.count()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["in_subquery_counts", "year_weekday_clean_users", "clean_users_local_weekdays"])
def test_facts_are_reduced_before_they_meet_a_key(spark, sf_small, no_broadcast, name):
    """No exchange carries raw fact rows: every one by a hot key is above a partial aggregate."""
    lines = _plan(QUERIES[name](spark, sf_small)).splitlines()
    scans = [i for i, x in enumerate(lines) if "FileScan" in x and ("events" in x or "lineitem" in x)]
    assert scans
    for at in scans:
        above = [x for x in lines[:at][::-1]]
        first = next(x for x in above if "Exchange" in x or "HashAggregate" in x)
        assert "HashAggregate" in first


def test_the_part_join_sees_month_rows_and_folders_are_pruned(spark, sf_small, tmp_path):
    from quarry.plans.periods import rise_nov_dec_dept
    from quarry.sources import Tables, publish_by_month

    for name in ("part", "supplier", "nation", "region", "lineitem"):
        getattr(Tables(spark, sf_small), name).write.parquet(f"{tmp_path}/{name}.parquet")
    plain = rise_nov_dec_dept(spark, str(tmp_path))
    text = _plan(plain)
    # The plan prints the join above what it reads: the aggregate by sku lies below it.
    assert text.index("l_partkey") < text.rindex("HashAggregate(keys=[l_partkey")
    want = plain.collect()
    publish_by_month(spark, f"{tmp_path}/lineitem.parquet", "l_shipdate", f"{tmp_path}/lineitem_by_month")
    pruned = rise_nov_dec_dept(spark, str(tmp_path))
    assert "part_month" in _formatted(pruned).split("PartitionFilters: [", 1)[1][:200]
    assert pruned.collect() == want


# Upper bounds on hash/range exchanges for plans that were tightened on purpose.
MAX_SHUFFLES = {"best_month_per_supplier": 3, "worst_month_per_supplier": 3,
                "returns_month_per_supplier": 3, "orphan_keys": 2, "join_star_four": 2,
                "avg_daily_revenue_supplier_month": 1, "distinct_days_per_month": 1,
                "profile_events": 2, "join_fanout": 2}


@pytest.mark.parametrize("name", sorted(MAX_SHUFFLES))
def test_shuffle_budget(spark, sf_small, name):
    plan = _plan(QUERIES[name](spark, sf_small))
    shuffles = plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")
    assert shuffles <= MAX_SHUFFLES[name]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"csv_roundtrip_texts"}))
def test_large_text_is_never_read(spark, sf_small, name):
    """Column pruning: the documents' text (up to 20,000 words a row) is not read."""
    text = _formatted(QUERIES[name](spark, sf_small))
    assert "text:string" not in text
