import pytest
from pyspark.sql import functions as F

from quarry.operators.spine import ProductTooLarge, fill, month_spine, product


def test_every_combination(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    right = spark.createDataFrame([("x", 0.5), (None, None)], "tag string, w double")
    got = {tuple(r) for r in product(left, right).collect()}
    assert got == {(1, "a", "x", 0.5), (1, "a", None, None), (2, None, "x", 0.5), (2, None, None, None)}


def test_bounds_raise_before_anything_is_multiplied(spark):
    left, right = spark.range(100), spark.range(20).toDF("other")
    assert product(left, right, max_rows=2000).count() == 2000
    with pytest.raises(ProductTooLarge):
        product(left, right, max_rows=1999)
    with pytest.raises(ProductTooLarge):
        product(left, right, max_right=19)
    with pytest.raises(ValueError):
        product(left, left)


def test_empty_sides(spark):
    left, none = spark.range(3), spark.createDataFrame([], "other long, day date")
    out = product(left, none)
    assert out.count() == 0 and out.columns == ["id", "other", "day"]
    assert product(none, left).count() == 0


def test_no_join_operator_in_the_plan(spark):
    plan = product(spark.range(5), spark.range(4).toDF("b"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan and "Exchange" not in plan


def test_months_without_rows_are_zero(spark):
    fact = spark.sql("""SELECT * FROM VALUES (1, timestamp_ntz'2023-11-30 23:59:59'), (1, timestamp_ntz'2024-03-01 00:00:00'),
                        (2, timestamp_ntz'2024-01-15 12:00:00'), (2, NULL) AS t(id, ts)""")
    spine = month_spine(spark.range(1, 4), fact, "ts")
    counts = fact.groupBy("id", F.trunc("ts", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    got = {(r["id"], r["month"].isoformat()[:7]): r["n"] for r in fill(spine, counts, ["id", "month"], ["n"]).collect()}
    assert len(got) == 3 * 5
    assert {k: v for k, v in got.items() if v} == {(1, "2023-11"): 1, (1, "2024-03"): 1, (2, "2024-01"): 1}
    assert month_spine(spark.range(3), fact.where("ts IS NULL"), "ts").count() == 0
