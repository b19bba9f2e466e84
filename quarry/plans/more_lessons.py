"""Further questions of the lessons: period changes of whole stores and departments
in daily revenue, clean users by place and local weekday, joins on one key or
both, two-label averages, negative durations in full, and NULL-key joins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import (WEEKDAYS_MONDAY_FIRST, not_flagged, order_by_list, pct_change, shift_hours, weekday_name,
                              whole_units_between)
from quarry.operators import (broadcast_if_small, dedupe_join, join_back_top, per_key,
                              profile_table, scaled_ratio, spread, top_k)
from quarry.plans.basics import SEG_SQL, segment_with_gaps
from quarry.plans.periods import (MIN_DAYS, MIN_DAYS_FINE, _dept_month_stats, _store_places, _two_month_stats)
from quarry.plans.registry import report
from quarry.sources import Tables, preview

_CENTS = "CAST(ROUND(l_extendedprice * 100) AS BIGINT)"
_PLACE_SQL = """JOIN supplier s ON s.s_suppkey = rates.l_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey"""


def _rates_sql(keys: str, first: int, second: int, min_days: int) -> str:
    """CTEs ending in ``rates``: daily revenue before and after, per ``keys``."""
    return f"""
sold AS (
  SELECT {keys}, month(l_shipdate) AS mo, CAST(l_shipdate AS DATE) AS day, {_CENTS} AS cents
  FROM lineitem {"JOIN part ON p_partkey = l_partkey" if "p_type" in keys else ""}
  WHERE l_returnflag <> 'R' AND l_extendedprice <> 0 AND month(l_shipdate) IN ({first}, {second})
    AND strftime(l_shipdate, '%Y-%m') <> '2001-11'),
months AS (
  SELECT {keys}, mo, SUM(cents) AS cents, COUNT(DISTINCT day) AS days
  FROM sold GROUP BY {keys}, mo HAVING COUNT(DISTINCT day) >= {min_days}),
rates AS (
  SELECT {keys}, CAST(a.cents AS DOUBLE) / 100 / a.days AS before_daily, CAST(b.cents AS DOUBLE) / 100 / b.days AS after_daily
  FROM months a JOIN months b USING ({keys}) WHERE a.mo = {first} AND b.mo = {second})"""


def _with_rates(stats, min_days: int):
    """Daily revenue of both periods where each has enough sale days."""
    return (stats.filter((F.col("a_days") >= min_days) & (F.col("b_days") >= min_days))
            .withColumn("before_daily", scaled_ratio("a_sales", "a_days", 100))
            .withColumn("after_daily", scaled_ratio("b_sales", "b_days", 100)))


@report("rise_nov_dec_supplier_amount", ops=("Q3", "A14", "A15", "O6"), sql=f"""
WITH {_rates_sql("l_suppkey", 11, 12, MIN_DAYS)}
SELECT rates.l_suppkey, n.n_name AS city, r.r_name AS state, before_daily, after_daily,
       after_daily - before_daily AS daily_increase
FROM rates {_PLACE_SQL}
ORDER BY daily_increase DESC, rates.l_suppkey LIMIT 1
""")
def rise_nov_dec_supplier_amount(spark, sf_dir, min_days: int = MIN_DAYS):
    """Store with the greatest absolute rise in average daily revenue Nov → Dec."""
    t = Tables(spark, sf_dir)
    s = _with_rates(_two_month_stats(t, ["l_suppkey"], 11, 12), min_days).withColumn(
        "daily_increase", F.col("after_daily") - F.col("before_daily"))
    best = top_k(s, 1, [F.col("daily_increase").desc(), F.col("l_suppkey").asc()])
    return join_back_top(_store_places(t), best, "l_suppkey").select(
        "l_suppkey", "city", "state", "before_daily", "after_daily", "daily_increase")


@report("fall_aug_sep_dept", ops=("Q3", "A14", "A15", "J4", "O6"), sql=f"""
WITH {_rates_sql("p_type, l_suppkey", 8, 9, MIN_DAYS_FINE)}
SELECT rates.p_type, rates.l_suppkey, n.n_name AS city, r.r_name AS state, before_daily, after_daily,
       before_daily - after_daily AS daily_fall
FROM rates {_PLACE_SQL}
ORDER BY daily_fall DESC, rates.p_type, rates.l_suppkey LIMIT 1
""")
def fall_aug_sep_dept(spark, sf_dir, min_days: int = MIN_DAYS_FINE):
    """Department-in-store with the greatest fall in average daily revenue Aug → Sep."""
    t = Tables(spark, sf_dir)
    s = _with_rates(_dept_month_stats(t, "cents", {"a": 8, "b": 9}), min_days).withColumn(
        "daily_fall", F.col("before_daily") - F.col("after_daily"))
    best = top_k(s, 1, [F.col("daily_fall").desc(), F.col("p_type").asc(), F.col("l_suppkey").asc()])
    return join_back_top(_store_places(t), best, "l_suppkey").select(
        "p_type", "l_suppkey", "city", "state", "before_daily", "after_daily", "daily_fall")


@report("rise_nov_dec_dept_any", ops=("Q3", "A14", "A15", "X18", "J4", "O6"), sql=f"""
WITH {_rates_sql("p_type, l_suppkey", 11, 12, MIN_DAYS_FINE)}
SELECT rates.p_type, rates.l_suppkey, n.n_name AS city, r.r_name AS state, before_daily, after_daily,
       (after_daily - before_daily) / before_daily * 100 AS pct_increase
FROM rates {_PLACE_SQL}
ORDER BY pct_increase DESC, rates.p_type, rates.l_suppkey LIMIT 1
""")
def rise_nov_dec_dept_any(spark, sf_dir, min_days: int = MIN_DAYS_FINE):
    """Department-in-store with the greatest % rise in daily revenue Nov → Dec, whatever its sales."""
    t = Tables(spark, sf_dir)
    s = _with_rates(_dept_month_stats(t, "cents", {"a": 11, "b": 12}), min_days).withColumn(
        "pct_increase", pct_change("after_daily", "before_daily"))
    best = top_k(s, 1, [F.col("pct_increase").desc(), F.col("p_type").asc(), F.col("l_suppkey").asc()])
    return join_back_top(_store_places(t), best, "l_suppkey").select(
        "p_type", "l_suppkey", "city", "state", "before_daily", "after_daily", "pct_increase")


@report("clean_users_local_weekdays", ops=("J13", "D7", "F4", "F11", "X7", "X11", "D14", "O7", "A12"), sql=f"""
WITH clean AS (
  SELECT DISTINCT c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
  WHERE c_acctbal >= 0 AND r_name = 'AMERICA' AND n_name NOT IN ('CANADA', 'PERU')),
home AS (SELECT user_id, ts - INTERVAL 6 HOUR AS seen FROM events WHERE event_type IS DISTINCT FROM 'error')
SELECT CAST(year(seen) AS INTEGER) AS local_year, dayname(seen) AS weekday, COUNT(*) AS n_events
FROM home JOIN clean ON c_custkey = user_id
GROUP BY 1, 2
ORDER BY 1 DESC, list_position(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'], any_value(dayname(seen)))
""")
def clean_users_local_weekdays(spark, sf_dir, hours: int = -6):
    """Events of clean, de-duplicated users of one region without two of its nations, per
    year and weekday of the users' local time, in calendar order."""
    t = Tables(spark, sf_dir)
    home = (t.nation.filter(~F.col("n_name").isin("CANADA", "PERU"))
            .join(broadcast_if_small(t.region.filter(F.col("r_name") == "AMERICA")),
                  F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey")))
    clean = (t.customer.filter(F.col("c_acctbal") >= 0).join(broadcast_if_small(home), "c_nationkey")
             .select(F.col("c_custkey").alias("user_id")).distinct())
    at = shift_hours("ts", hours)
    per_user = t.events.filter(not_flagged("event_type", "error")).groupBy(
        "user_id", F.year(at).alias("local_year"), weekday_name(at).alias("weekday")).agg(
            F.count(F.lit(1)).alias("n_events"))
    return (per_user.join(clean, "user_id").groupBy("local_year", "weekday").agg(F.sum("n_events").alias("n_events"))
            .orderBy(F.col("local_year").desc(), order_by_list("weekday", WEEKDAYS_MONDAY_FIRST)))


_TOP_CLEAN_SQL = """
WITH clean AS (
  SELECT DISTINCT c_custkey, c_nationkey FROM customer WHERE c_acctbal >= 0 AND c_custkey IN (
    SELECT user_id FROM events WHERE event_type IS DISTINCT FROM 'error'))
SELECT n_name, COUNT(DISTINCT c_custkey) AS n_users
FROM clean JOIN nation ON n_nationkey = c_nationkey {where}
GROUP BY n_name ORDER BY n_users DESC, n_name LIMIT {k}
"""


def _top_clean_nations(t: Tables, nations, k: int):
    """Nations by distinct clean users; flags removed on both sides, both de-duplicated."""
    active = t.events.filter(not_flagged("event_type", "error")).select(F.col("user_id").alias("c_custkey"))
    users = dedupe_join(active, t.customer.filter(F.col("c_acctbal") >= 0), "c_custkey", right_cols=["c_nationkey"])
    named = users.join(broadcast_if_small(nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")),
                       "c_nationkey").select("n_name", "c_custkey").distinct()
    return top_k(named.groupBy("n_name").agg(F.count("c_custkey").alias("n_users")), k,
                 [F.desc("n_users"), F.asc("n_name")])


@report("top_nations_clean_users", ops=("O6", "J13", "D7", "F11", "A3"),
        sql=_TOP_CLEAN_SQL.format(where="", k=10))
def top_nations_clean_users(spark, sf_dir, k: int = 10):
    """The ten nations with most distinct clean users."""
    t = Tables(spark, sf_dir)
    return _top_clean_nations(t, t.nation, k)


@report("top_nations_clean_users_region", ops=("O6", "J13", "D7", "F11", "A3", "J10"), sql=_TOP_CLEAN_SQL.format(
    where="WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')", k=5))
def top_nations_clean_users_region(spark, sf_dir, k: int = 5):
    """The five nations of one region with most distinct clean users."""
    t = Tables(spark, sf_dir)
    asia = t.region.filter(F.col("r_name") == "ASIA").select(F.col("r_regionkey").alias("n_regionkey"))
    return _top_clean_nations(t, t.nation.join(broadcast_if_small(asia), "n_regionkey", "left_semi"), k)


#: Orders count as due this many days after their date; earlier shipments have a negative delay.
DUE_DAYS = 10


@report("negative_duration_rows", ops=("D2", "X9", "F13"), sql=f"""
SELECT l.*, o.o_orderdate, date_sub('minute', o.o_orderdate + INTERVAL {DUE_DAYS} DAY, l.l_shipdate) AS delay_minutes
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE date_sub('minute', o.o_orderdate + INTERVAL {DUE_DAYS} DAY, l.l_shipdate) < 0
""")
def negative_duration_rows(spark, sf_dir):
    """The full rows whose end precedes their start: lines shipped before they were due."""
    t = Tables(spark, sf_dir)
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    due = F.col("o_orderdate") + F.make_dt_interval(days=F.lit(DUE_DAYS))
    j = t.lineitem.join(o, "l_orderkey").withColumn("delay_minutes", whole_units_between("MINUTE", due, "l_shipdate"))
    return j.filter(F.col("delay_minutes") < 0).select(*t.lineitem.columns, "o_orderdate", "delay_minutes")


@report("join_on_one_key_or_both", ops=("J1", "J2", "J3", "J14"), sql="""
WITH b AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N'),
     r AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'),
bp AS (SELECT l_partkey, COUNT(*) AS n FROM b GROUP BY 1), rp AS (SELECT l_partkey, COUNT(*) AS n FROM r GROUP BY 1),
bs AS (SELECT l_suppkey, COUNT(*) AS n FROM b GROUP BY 1), rs AS (SELECT l_suppkey, COUNT(*) AS n FROM r GROUP BY 1)
SELECT 'part' AS joined_on, CAST(SUM(bp.n * rp.n) AS BIGINT) AS n_rows FROM bp JOIN rp USING (l_partkey)
UNION ALL SELECT 'supplier', CAST(SUM(bs.n * rs.n) AS BIGINT) FROM bs JOIN rs USING (l_suppkey)
UNION ALL SELECT 'both', COUNT(*) FROM b JOIN r USING (l_partkey, l_suppkey)
""")
def join_on_one_key_or_both(spark, sf_dir):
    """Rows that joining kept to returned lines gives on the sku, on the store, and on both:
    products of per-key counts, no joined row is made."""
    li = Tables(spark, sf_dir).lineitem
    kept, back = (li.filter(F.col("l_returnflag") == f) for f in ("N", "R"))
    out = None
    for name, keys in (("part", ["l_partkey"]), ("supplier", ["l_suppkey"]), ("both", ["l_partkey", "l_suppkey"])):
        a, b = (side.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for side, n in ((kept, "n_kept"), (back, "n_back")))
        row = a.join(b, keys).agg(F.lit(name).alias("joined_on"),
                                  F.sum(F.col("n_kept") * F.col("n_back")).alias("n_rows"))
        out = row if out is None else out.unionByName(row)
    return out.select("joined_on", "n_rows")


@report("orders_by_two_labels", ops=("A17", "A19", "X13", "X15"), sql=f"""
WITH labelled AS (
  SELECT c_custkey, CASE {SEG_SQL} WHEN '' THEN 'unnamed' WHEN 'BUILDING' THEN 'building' END AS kind,
         if(c_acctbal < 0, 'debt', 'credit') AS balance
  FROM customer),
per AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT kind, balance, COUNT(*) AS n_customers, AVG(n) AS avg_orders
FROM labelled JOIN per ON o_custkey = c_custkey GROUP BY kind, balance
""")
def orders_by_two_labels(spark, sf_dir):
    """Average orders per customer by two labels at once; customers that the first label
    does not name form a NULL group, so there are three times two groups."""
    t = Tables(spark, sf_dir)
    seg = segment_with_gaps()
    kind = F.when(seg == "", "unnamed").when(seg == "BUILDING", "building")
    balance = F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit")
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    labelled = t.customer.select("c_custkey", kind.alias("kind"), balance.alias("balance"))
    return labelled.join(per, "c_custkey").groupBy("kind", "balance").agg(
        F.count(F.lit(1)).alias("n_customers"), F.avg("n").alias("avg_orders"))


@report("null_key_join", ops=("D13", "J2", "A1"), sql="""
WITH blanked AS (SELECT NULL::BIGINT AS user_id, o_custkey, o_orderkey FROM orders)
SELECT (SELECT COUNT(*) FROM blanked b JOIN customer c ON c.c_custkey = b.user_id) AS n_on_null_key,
       (SELECT COUNT(*) FROM blanked b JOIN customer c ON c.c_custkey = b.o_custkey) AS n_on_other_key,
       (SELECT COUNT(*) - COUNT(user_id) FROM blanked) AS n_null_keys,
       (SELECT string_agg(name, ',' ORDER BY name) FROM (SELECT 'user_id' AS name FROM blanked HAVING COUNT(user_id) = 0))
         AS empty_columns
""")
def null_key_join(spark, sf_dir):
    """A join column that holds nothing but NULL: found by the table's profile, and a join
    on it matches no row, where the other key matches."""
    t = Tables(spark, sf_dir)
    blanked = t.orders.select(F.lit(None).cast("long").alias("user_id"), "o_custkey", "o_orderkey")
    c = per_key(t.customer, "c_custkey")

    def joined(key):
        per = blanked.groupBy(F.col(key).alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
        return F.coalesce(per.join(c, "c_custkey").agg(F.sum(F.col("n") * F.col("copies"))).scalar(), F.lit(0))

    # One row a column: at most as many names as the table has columns.
    empty = F.collect_list(F.when(F.col("n_non_null") == 0, F.col("column_name")))
    return profile_table(blanked).agg(
        F.coalesce(F.max(F.when(F.col("column_name") == "user_id", F.col("n_nulls"))), F.lit(0)).alias("n_null_keys"),
        F.array_join(F.array_sort(empty), ",").alias("empty_columns")).select(
            joined("user_id").alias("n_on_null_key"), joined("o_custkey").alias("n_on_other_key"),
            "n_null_keys", "empty_columns")


@report("coerced_comparisons", ops=("F15", "F1"), sql="""
SELECT COUNT(*) FILTER (year(o_orderdate) = CAST('1997' AS INTEGER)) AS n_year_text,
       COUNT(*) FILTER (year(o_orderdate) = 1997) AS n_year_number,
       COUNT(*) FILTER (o_custkey <> CAST('7' AS BIGINT)) AS n_not_text_key
FROM orders
""")
def coerced_comparisons(spark, sf_dir):
    """Numbers compared to text literals: Spark casts the text, as the lessons' SQL does."""
    o = Tables(spark, sf_dir).orders
    year = F.year("o_orderdate")
    return o.agg(F.count_if(year == "1997").alias("n_year_text"), F.count_if(year == 1997).alias("n_year_number"),
                 F.count_if(F.col("o_custkey") != "7").alias("n_not_text_key"))


@report("preview_customers", ops=("S6", "O4"), sql="""
SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey NULLS FIRST, c_name LIMIT 1000
""")
def preview_customers(spark, sf_dir):
    """The display cap: the first 1,000 rows of an ordered result (the cap is the feature)."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment")
    return preview(c.orderBy("c_custkey", "c_name"), 1000)


@report("balance_spread_by_segment", ops=("A6", "A7", "A8", "A9", "A22", "D11"), sql="""
SELECT c_mktsegment, COUNT(*) AS n_customers, ROUND(AVG(c_acctbal), 6) AS bal_avg,
       ROUND(stddev_pop(c_acctbal), 6) AS bal_std_pop, ROUND(stddev_samp(c_acctbal), 6) AS bal_std_samp,
       quantile_disc(c_acctbal, 0.5) AS bal_median, ROUND(stddev_pop(c_acctbal) / AVG(c_acctbal), 6) AS bal_cv
FROM customer GROUP BY c_mktsegment
""")
def balance_spread_by_segment(spark, sf_dir):
    """Spread of balances per segment with the sketch median, whose memory does not grow with a group."""
    out = Tables(spark, sf_dir).customer.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_customers"), *spread("c_acctbal", "bal"))
    return out.select("c_mktsegment", "n_customers", "bal_median",
                      *[F.round(c, 6).alias(c) for c in ("bal_avg", "bal_std_pop", "bal_std_samp", "bal_cv")])
