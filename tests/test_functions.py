"""Column helpers on hand-made frames with the irregularities the driver data lacks."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.functions import (WEEKDAYS_MONDAY_FIRST, Bin, bin_by, ci_eq, ci_like, clean_label,
                              day_bit, drop_period, in_period, map_values, month_abbrev, not_blank,
                              not_flagged, order_by_list, pct_change, ratio, shift_hours, two_way,
                              weekday_name, weekday_number, whole_units_between)


def test_not_flagged_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "id int, exclude int")
    assert sorted(r.id for r in df.filter(not_flagged("exclude")).collect()) == [2, 3]
    # the naive form loses the NULL row
    assert sorted(r.id for r in df.filter(F.col("exclude") != 1).collect()) == [2]


def test_blank_is_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "id int, category string")
    assert [r.id for r in df.filter(not_blank("category")).collect()] == [1]
    assert df.filter(F.col("category").isNotNull()).count() == 2


def test_case_insensitive_match(spark):
    df = spark.createDataFrame([("Golden Retriever",), ("golden retriever",), ("Beagle",)], "s string")
    assert df.filter(ci_eq("s", "GOLDEN RETRIEVER")).count() == 2
    assert df.filter(ci_like("s", "g%")).count() == 2
    assert df.filter(F.col("s").like("g%")).count() == 1


def test_whole_units_truncate_toward_zero(spark):
    base = dt.datetime(2014, 1, 1, 0, 0, 0)
    rows = [(1, base, base + dt.timedelta(seconds=119)), (2, base, base + dt.timedelta(seconds=59)),
            (3, base, base), (4, base, base - dt.timedelta(seconds=119))]
    df = spark.createDataFrame(rows, "id int, a timestamp_ntz, b timestamp_ntz")
    got = {r.id: r.m for r in df.select("id", whole_units_between("minute", "a", "b").alias("m")).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: -1}


def test_weekday_names_and_numbers(spark):
    df = spark.createDataFrame([(dt.datetime(2013, 2, 3, 1, 0),)], "ts timestamp_ntz")  # a Sunday
    r = df.select(weekday_name("ts").alias("n"), weekday_number("ts").alias("d"),
                  weekday_name(shift_hours("ts", -6)).alias("shifted")).first()
    assert (r.n, r.d, r.shifted) == ("Sunday", 1, "Saturday")
    pos = df.select(order_by_list(F.lit("Sunday"), WEEKDAYS_MONDAY_FIRST).alias("p"),
                    order_by_list(F.lit("Funday"), WEEKDAYS_MONDAY_FIRST).alias("q")).first()
    assert (pos.p, pos.q) == (7, 0)


def test_label_cleaning(spark):
    df = spark.createDataFrame([("-Beagle",), ("Beagle- Mix",), ("beagle mix",), (None,)], "s string")
    out = df.select(clean_label("s", strip_leading="-").alias("a"),
                    clean_label("s", replace=("- ", " "), upper=True).alias("b")).collect()
    assert [r.a for r in out] == ["Beagle", "Beagle- Mix", "beagle mix", None]
    assert [r.b for r in out] == ["-BEAGLE", "BEAGLE MIX", "BEAGLE MIX", None]


def test_bin_edges(spark):
    bins = [Bin("low", 50, 60), Bin("medium", 60, 70, lo_closed=False), Bin("high", 70, None, lo_closed=False)]
    xs = [49.99, 50.0, 50.01, 59.99, 60.0, 60.01, 69.99, 70.0, 70.01, None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, x double")
    got = [r.c for r in df.orderBy("id").select(bin_by("x", bins, "very low").alias("c")).collect()]
    assert got == ["very low", "low", "low", "low", "low", "medium", "medium", "medium", "high", "very low"]


def test_if_case_simple_case_agree(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "s string")
    s = F.col("s")
    out = df.select(two_way(s == "a", F.lit("A"), two_way(s == "b", F.lit("B"), F.lit("other"))).alias("x"),
                    F.when(s == "a", "A").when(s == "b", "B").otherwise("other").alias("y"),
                    map_values("s", {"a": "A", "b": "B"}, "other").alias("z")).collect()
    assert all(r.x == r.y == r.z for r in out)
    assert [r.x for r in out] == ["A", "B", "other", "other"]


def test_period_predicates(spark):
    ts = [dt.datetime(2005, 7, 31, 23, 59), dt.datetime(2005, 8, 1), dt.datetime(2005, 8, 31, 23, 59),
          dt.datetime(2005, 9, 1), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id int, ts timestamp_ntz")
    assert sorted(r.id for r in df.filter(drop_period("ts", 2005, 8)).collect()) == [0, 3]
    assert sorted(r.id for r in df.filter(in_period("ts", 2005, 8)).collect()) == [1, 2]
    assert sorted(r.id for r in df.filter(in_period("ts", 2005)).collect()) == [0, 1, 2, 3]
    # December rolls into the next year
    assert df.filter(in_period("ts", 2005, 12)).count() == 0


def test_ratio_and_pct_change_null_on_zero(spark):
    df = spark.createDataFrame([(10.0, 0.0), (15.0, 10.0), (None, 1.0)], "new double, old double")
    out = df.select(ratio("new", "old").alias("r"), pct_change("new", "old").alias("p")).collect()
    assert out[0].r is None and out[0].p is None
    assert out[1].r == 1.5 and out[1].p == 50.0
    assert out[2].r is None


def test_month_names_and_labels(spark):
    df = spark.createDataFrame([(m,) for m in (1, 9, 12, 13)], "m int")
    assert [r.n for r in df.select(month_abbrev("m").alias("n")).collect()] == ["Jan", "Sep", "Dec", None]


def test_day_bitmap_counts_distinct_days(spark):
    days = [dt.datetime(2005, 3, d, h) for d in (1, 1, 2, 15, 31) for h in (0, 12)]
    df = spark.createDataFrame([(t,) for t in days] + [(None,)], "ts timestamp_ntz")
    r = df.agg(F.bit_count(F.bit_or(day_bit("ts"))).alias("n"),
               F.countDistinct(F.to_date("ts")).alias("m")).first()
    assert r.n == r.m == 4
