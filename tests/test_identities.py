"""The identities the original lessons' stated results obey, checked on the driver tables."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from quarry.operators import anti, anti_by_outer_join, fanout, profile_table
from quarry.plans.basics import segment_with_gaps
from quarry.sources import Tables


def test_count_is_nonnull_plus_null(spark, sf_small):
    t = Tables(spark, sf_small)
    j = t.documents.join(t.labels, "doc_id", "left")
    r = j.agg(F.count(F.lit(1)).alias("all"), F.count("quality").alias("nn"),
              F.count_if(F.col("quality").isNull()).alias("nulls")).first()
    assert r.all == r.nn + r.nulls
    for p in profile_table(j.select("doc_id", "quality", "toxic")).collect():
        assert p.n_rows == p.n_nulls + p.n_non_null


def test_groups_are_distinct_plus_null(spark, sf_small):
    c = Tables(spark, sf_small).customer.select(segment_with_gaps().alias("seg"))
    groups = c.groupBy("seg").count().count()
    distinct = c.agg(F.countDistinct("seg")).first()[0]
    has_null = c.filter(F.col("seg").isNull()).count() > 0
    assert groups == distinct + (1 if has_null else 0)


def test_join_rows_are_left_times_right(spark, sf_small):
    t = Tables(spark, sf_small)
    f = fanout(t.orders, t.events, "o_custkey", "user_id")
    total = f.agg(F.sum("n_pairs")).first()[0]
    assert total == t.orders.join(t.events, F.col("o_custkey") == F.col("user_id")).count()


def test_left_join_is_inner_plus_unmatched(spark, sf_small):
    t = Tables(spark, sf_small)
    users = t.events.select("user_id").distinct()
    c = t.customer.select("c_custkey")
    left = c.join(users, F.col("c_custkey") == F.col("user_id"), "left").count()
    inner = c.join(users, F.col("c_custkey") == F.col("user_id"), "inner").count()
    unmatched = anti(c, users.withColumnRenamed("user_id", "c_custkey"), "c_custkey").count()
    assert left == inner + unmatched


def test_three_anti_join_forms_agree(spark, sf_small):
    r = entry.queries()["anti_three_ways"](spark, sf_small).first()
    assert r.n_left_join == r.n_right_join == r.n_not_exists == r.n_not_in
    t = Tables(spark, sf_small)
    c, e = t.customer.select("c_custkey"), t.events.select("user_id")
    assert anti_by_outer_join(c, e, "c_custkey", "user_id").count() == r.n_left_join


def test_if_case_forms_agree(spark, sf_small):
    rows = entry.queries()["if_case_equivalence"](spark, sf_small).collect()
    assert rows and all(r.label_if == r.label_case == r.label_simple for r in rows)


def test_distinct_minus_joined_is_orphans(spark, sf_small):
    t = Tables(spark, sf_small)
    all_c = t.customer.select("c_custkey").distinct().count()
    joined = (t.customer.join(t.events, F.col("c_custkey") == F.col("user_id"))
              .select("c_custkey").distinct().count())
    orphans = entry.queries()["orphan_keys"](spark, sf_small).filter(F.col("only_in") == "customer").count()
    assert all_c - joined == orphans


def test_dedupe_never_exceeds_raw(spark, sf_small):
    for r in entry.queries()["dedupe_before_join"](spark, sf_small).collect():
        assert 1 <= r.n_line_numbers <= r.n_rows


def test_join_pairs_from_counts(spark, sf_small):
    li = Tables(spark, sf_small).lineitem
    b = li.filter(F.col("l_returnflag") != "R").alias("b")
    r = li.filter(F.col("l_returnflag") == "R").alias("r")
    raw = b.join(r, ["l_partkey", "l_suppkey"]).count()
    agg = entry.queries()["join_inner_two_keys"](spark, sf_small).agg(F.sum("joined_rows")).first()[0]
    assert raw == agg
