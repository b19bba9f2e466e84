import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.operators.distincts import (SketchStore, bitmap_counts, bitmap_table, merge_bitmaps, merged_profile,
                                        sketches)
from quarry.plans import QUERIES
from quarry.session import shared_dir, unique_name
from quarry.sources import Tables

def month():
    return F.date_format("l_shipdate", "yyyy-MM")


def test_ids_of_all_sizes_and_nulls(spark):
    ids = [0, 1, 32767, 32768, 32769, 10**12, -1, -40_000, None, 1, 0]
    df = spark.createDataFrame([(i, i, "a" if n % 2 else "b") for n, i in enumerate(ids)], "x long, y long, p string")
    table = bitmap_table(df, {"p": F.col("p")}, {"x": "x", "y": "y"})
    assert bitmap_counts(table, ["x", "y"]).collect() == [(8, 8)]
    want = {p: len({i for n, i in enumerate(ids) if i is not None and (n % 2 == 1) == (p == "a")}) for p in "ab"}
    assert {r["p"]: r["x"] for r in bitmap_counts(table, ["x"], "p").collect()} == want
    assert bitmap_counts(bitmap_table(df.limit(0), {"p": F.col("p")}, {"x": "x"}), ["x"]).collect() == [(0,)]
    with pytest.raises(TypeError):
        bitmap_table(df, {}, {"p": "p"})


def test_tables_of_parts_merge_to_the_table_of_the_whole(spark, sf_small):
    fact = Tables(spark, sf_small).lineitem
    period, ids = {"month": month()}, {"parts": "l_partkey", "orders": "l_orderkey"}
    early = bitmap_table(fact.where("l_linenumber <= 3"), period, ids)
    late = bitmap_table(fact.where("l_linenumber > 3"), period, ids)
    merged = merge_bitmaps(early.unionByName(late), "month")
    for periods in (["month"], []):
        got = bitmap_counts(merged, list(ids), *periods).collect()
        want = fact.withColumn("month", month()).groupBy(*periods).agg(
            F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_orderkey").alias("orders")).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_plan_without_expand_and_bitmaps_shared(spark, sf_small):
    df = QUERIES["distinct_by_month_and_total"](spark, sf_small)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "ReusedExchange" in plan


def test_union_of_sketches_is_near_the_exact_count(spark, sf_small):
    fact = Tables(spark, sf_small).lineitem.withColumn("month", month()).withColumn("none", F.lit(None).cast("string"))
    columns = ["l_orderkey", "l_extendedprice", "l_returnflag", "none"]
    got = {r["column_name"]: r for r in merged_profile(sketches(fact, columns, "month")).collect()}
    for c in columns:
        exact = fact.agg(F.countDistinct(c)).first()[0]
        assert abs(got[c]["n_distinct"] - exact) <= 0.02 * exact
        assert got[c]["n_rows"] == fact.count() and got[c]["n_nulls"] == fact.where(F.col(c).isNull()).count()


def test_store_reads_new_months_alone(spark, sf_small):
    fact = Tables(spark, sf_small).lineitem
    path = shared_dir(spark, unique_name("sketch-test"))
    store = SketchStore(spark, path, ["l_partkey", "l_shipdate"], "l_shipdate")
    assert store.months() == []
    old = fact.where("l_shipdate < timestamp_ntz'2000-06-01 00:00:00'")
    store.refresh(old)
    before = {(r["month"], r["column_name"]): (r["n_rows"], bytes(r["sketch"])) for r in store.read().collect()}
    # Were an old month read again, these changed rows would change its numbers.
    changed = fact.where("l_shipdate >= timestamp_ntz'2000-06-01 00:00:00'").unionByName(old.unionByName(old))
    seen = []

    class Spied(SketchStore):
        pass

    import quarry.operators.distincts as module
    plain = module.sketches

    def spy(df, *a):
        seen.append(df)
        return plain(df, *a)

    module.sketches = spy
    try:
        Spied(spark, path, ["l_partkey", "l_shipdate"], "l_shipdate").refresh(changed)
    finally:
        module.sketches = plain
    assert seen[0].agg(F.min("l_shipdate")).first()[0] >= dt.datetime(2000, 6, 1)
    assert "PushedFilters: [" in seen[0]._jdf.queryExecution().executedPlan().toString()
    after = {(r["month"], r["column_name"]): (r["n_rows"], bytes(r["sketch"])) for r in store.read().collect()}
    assert all(after[k] == v for k, v in before.items()) and len(after) > len(before)
    total = {r["column_name"]: r for r in store.profile().collect()}
    assert total["l_partkey"]["n_rows"] == fact.count()
    assert len(store.months()) == fact.select(F.trunc("l_shipdate", "month")).distinct().count()
    # A month asked for again is computed anew.
    store.refresh(changed, again=[dt.date(1996, 1, 1)])
    twice = {(r["month"], r["column_name"]): r["n_rows"] for r in store.read().collect()}
    assert twice[dt.date(1996, 1, 1), "l_partkey"] == 2 * before[dt.date(1996, 1, 1), "l_partkey"][0]
    assert twice[dt.date(1996, 2, 1), "l_partkey"] == before[dt.date(1996, 2, 1), "l_partkey"][0]
