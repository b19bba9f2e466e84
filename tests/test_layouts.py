import os

import pytest
from pyspark.sql import functions as F

from quarry.plans import QUERIES
from quarry.session import shared_dir, unique_name
from quarry.sources import Tables, publish_bucketed, publish_by_month, write_by_month
from quarry.sources.layouts import bucketed, bucketed_name, by_month_is_current

DURATIONS = ["duration_minutes_stats", "negative_durations", "rows_above_average_duration", "duration_hours_by_priority"]


@pytest.fixture
def own(spark, sf_small, tmp_path):
    for name in ("orders", "lineitem"):
        getattr(Tables(spark, sf_small), name).write.parquet(f"{tmp_path}/{name}.parquet")
    yield str(tmp_path)
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        spark.sql(f"DROP TABLE IF EXISTS {bucketed_name(f'{tmp_path}/{name}.parquet', key)}")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_durations_without_a_shuffle_of_facts(spark, own):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = {n: QUERIES[n](spark, own) for n in DURATIONS}
        want = {n: rows(df) for n, df in plain.items()}
        # Without the layout: the fallback shuffles both sides.
        for n, df in plain.items():
            assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(l_orderkey") >= 1
        for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
            publish_bucketed(spark, f"{own}/{name}.parquet", key, 4, shared_dir(spark, unique_name("bucketed")))
        for n in DURATIONS:
            df = QUERIES[n](spark, own)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "orderkey#" not in "".join(
                line for line in plan.splitlines() if "Exchange" in line)
            assert rows(df) == want[n]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_stale_bucketed_copy_is_not_used(spark, own):
    source = f"{own}/orders.parquet"
    assert bucketed(spark, source, "o_orderkey") is None
    publish_bucketed(spark, source, "o_orderkey", 2, shared_dir(spark, unique_name("bucketed")))
    assert bucketed(spark, source, "o_orderkey").count() == spark.read.parquet(source).count()
    spark.read.parquet(source).limit(5).write.mode("append").parquet(source)
    assert bucketed(spark, source, "o_orderkey") is None
    assert Tables(spark, own).by_key("orders", "o_orderkey").count() == spark.read.parquet(source).count()


def test_a_half_written_or_stale_copy_by_month_is_not_used(spark, own):
    source, copy = f"{own}/lineitem.parquet", f"{own}/lineitem_by_month"
    t = Tables(spark, own)
    want = t.lineitem.where(F.month("l_shipdate") == 5).count()
    write_by_month(t.lineitem.limit(100), copy, "l_shipdate")  # no mark: not finished, or by other means
    assert not by_month_is_current(spark, source, copy)
    assert t.in_months("lineitem", "l_shipdate", [5]).count() == want
    publish_by_month(spark, source, "l_shipdate", copy)
    assert by_month_is_current(spark, source, copy)
    assert t.in_months("lineitem", "l_shipdate", [5]).count() == want
    assert "lineitem_by_month" in t.in_months("lineitem", "l_shipdate", [5]).inputFiles()[0]
    t.lineitem.limit(7).write.mode("append").parquet(source)
    assert not by_month_is_current(spark, source, copy)
    assert t.in_months("lineitem", "l_shipdate", [5]).count() == t.lineitem.where(F.month("l_shipdate") == 5).count()
    assert os.path.exists(copy)
