import pytest
from pyspark.sql import functions as F

from quarry.operators import semi
from quarry.operators.key_filter import filtered_semi, key_words, may_match
from quarry.sources import Tables


@pytest.mark.parametrize("bits", [64, 4096, 1 << 24])
def test_equals_the_plain_semi_join(spark, bits):
    left = spark.createDataFrame([(i % 97 if i % 11 else None, f"r{i}") for i in range(500)], "k long, name string")
    right = spark.createDataFrame([(i,) for i in (1, 1, 5, 50, 96, 1000, None)], "k long")
    want = sorted(map(tuple, semi(left, right, "k").collect()))
    assert sorted(map(tuple, filtered_semi(left, right, "k", bits).collect())) == want
    assert filtered_semi(left, right.limit(0), "k", bits).count() == 0
    two = left.withColumn("j", F.length("name"))
    keys = two.where("k = 5 OR name = 'r7'").select("k", "j")
    assert filtered_semi(two, keys, ["k", "j"], bits).count() == semi(two, keys, ["k", "j"]).count() > 0


def test_the_filter_has_a_fixed_size(spark):
    keys = spark.range(200_000).toDF("k")
    assert key_words(keys, ["k"], 1 << 12).count() == 64
    with pytest.raises(ValueError):
        may_match(keys, keys, ["k"], 100)


def test_few_rows_reach_the_shuffle(spark, sf_small):
    t = Tables(spark, sf_small)
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    few = t.orders.where("o_orderkey % 50 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    kept = may_match(lines, few, ["l_orderkey"])
    exact = semi(lines, few, "l_orderkey").count()
    assert exact <= kept.count() <= exact + 0.01 * lines.count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # The fact meets the words in its own task.
    assert "BroadcastHashJoin" in plan and "hashpartitioning(l_orderkey" not in plan
