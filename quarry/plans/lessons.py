"""More single-question reports from the lesson cells: NULL groups produced by outer
joins, IN / NOT IN subqueries, first/last/total per entity, two-stage averages with
NULL-tolerant exclusions, and hour durations with their spread.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import after, map_values, not_flagged, two_way, weekday_name, whole_units_between
from quarry.operators import anti, broadcast_if_small, per_key, semi
from quarry.plans.basics import SEG_SQL, segment_with_gaps
from quarry.plans.registry import report
from quarry.sources import Tables, register_views


@report("group_by_right_key_null", ops=("A19", "J5", "A20"), sql="""
SELECT e.user_id, COUNT(*) AS n_customers
FROM customer c LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON c.c_custkey = e.user_id
GROUP BY e.user_id
""")
def group_by_right_key_null(spark, sf_dir):
    """Grouping a LEFT JOIN by the right side's key: every unmatched row lands in one
    NULL group - the "wrong key" lesson."""
    t = Tables(spark, sf_dir)
    users = t.events.select("user_id").distinct()
    j = t.customer.select("c_custkey").join(users, F.col("c_custkey") == F.col("user_id"), "left")
    return j.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_customers"))


@report("in_subquery_counts", ops=("F4", "J10", "J11", "A3", "Q2"), sql="""
SELECT
  (SELECT COUNT(*) FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')) AS n_lines_in,
  (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')) AS n_orders_not_in
""")
def in_subquery_counts(spark, sf_dir):
    """``IN (subquery)`` and ``NOT IN (subquery)`` counts from one pass.

    Lines and urgent orders are stacked and reduced to one row per order key:
    its number of lines, and whether it is urgent.  Both counts follow from
    those rows, so a hot order is one row before it moves.  NOT IN gives
    nothing when the subquery yields a NULL key, and no NULL key passes it.
    """
    t = Tables(spark, sf_dir)
    lines = t.lineitem.select(F.col("l_orderkey").alias("key"), F.lit(1).alias("line"), F.lit(False).alias("urgent"))
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("key"), F.lit(0).alias("line"), F.lit(True).alias("urgent"))
    keys = lines.unionByName(urgent).groupBy("key").agg(F.sum("line").alias("n"), F.bool_or("urgent").alias("urgent"))
    known = F.col("key").isNotNull()
    counts = keys.agg(F.coalesce(F.sum(F.when(known & F.col("urgent"), F.col("n"))), F.lit(0)).alias("n_lines_in"),
                      F.count_if(known & ~F.col("urgent")).alias("n_not_in"),
                      F.count_if(~known & F.col("urgent")).alias("null_keys"))
    return counts.select("n_lines_in", F.when(F.col("null_keys") > 0, 0).otherwise(F.col("n_not_in"))
                         .cast("long").alias("n_orders_not_in"))


@report("first_last_per_customer", ops=("A6", "J2", "F6", "F7"), sql=f"""
SELECT c.c_custkey, MIN(o.o_orderdate) AS first_order, MAX(o.o_orderdate) AS last_order,
       COUNT(o.o_orderkey) AS n_orders
FROM (SELECT c_custkey, {SEG_SQL} AS seg FROM customer) c JOIN orders o ON c.c_custkey = o.o_custkey
WHERE c.seg = ''
GROUP BY c.c_custkey
""")
def first_last_per_customer(spark, sf_dir):
    """First, last and total orders of the customers whose segment is blank - not NULL."""
    t = Tables(spark, sf_dir)
    blank = t.customer.select("c_custkey", segment_with_gaps().alias("seg")).filter(F.col("seg") == "")
    per_cust = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"),
        F.count("o_orderkey").alias("n_orders"))
    return per_cust.join(per_key(blank, "c_custkey"), "c_custkey").select(
        "c_custkey", "first_order", "last_order", (F.col("n_orders") * F.col("copies")).alias("n_orders"))


@report("docs_per_source_by_lang", ops=("A17", "F11", "F4", "J5"), sql="""
WITH per_source AS (
  SELECT d.lang, d.source, COUNT(*) AS n_docs
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  WHERE (l.toxic IS NULL OR l.toxic = 0) AND d.lang IN ('en', 'fr', 'de')
  GROUP BY d.lang, d.source
)
SELECT lang, COUNT(*) AS n_sources, AVG(n_docs) AS avg_docs, MAX(n_docs) AS max_docs
FROM per_source GROUP BY lang
""")
def docs_per_source_by_lang(spark, sf_dir):
    """Documents per source, then the mean per language, excluding flagged documents
    NULL-tolerantly."""
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "lang", "source").filter(F.col("lang").isin("en", "fr", "de"))
    j = d.join(broadcast_if_small(t.labels.select("doc_id", "toxic")), "doc_id", "left")
    per_source = j.filter(not_flagged("toxic")).groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n_docs"))
    return per_source.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"),
                                          F.avg("n_docs").alias("avg_docs"),
                                          F.max("n_docs").alias("max_docs"))


@report("duration_hours_by_priority", ops=("X9", "A6", "A7", "A13", "D11"), sql="""
SELECT o.o_orderpriority, COUNT(*) AS n_lines,
       AVG(date_sub('hour', o.o_orderdate, l.l_shipdate)) AS avg_hours,
       ROUND(stddev_pop(date_sub('hour', o.o_orderdate, l.l_shipdate)), 6) AS std_hours
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE date_sub('hour', o.o_orderdate, l.l_shipdate) > 0
GROUP BY o.o_orderpriority
HAVING AVG(date_sub('hour', o.o_orderdate, l.l_shipdate)) > 24
""")
def duration_hours_by_priority(spark, sf_dir, min_avg_hours: float = 24.0):
    """Mean and spread of positive whole-hour durations per order priority, groups with a
    mean above a threshold."""
    t = Tables(spark, sf_dir)
    o = t.by_key("orders", "o_orderkey").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    j = t.by_key("lineitem", "l_orderkey").select("l_orderkey", "l_shipdate").join(o, "l_orderkey")
    d = j.withColumn("hours", whole_units_between("HOUR", "o_orderdate", "l_shipdate")).filter(F.col("hours") > 0)
    return (d.groupBy("o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.avg("hours").alias("avg_hours"),
                 F.round(F.stddev_pop("hours"), 6).alias("std_hours"))
            .filter(F.col("avg_hours") > min_avg_hours))


@report("customers_home_region", ops=("P7", "X13", "A12", "A3", "J4"), sql="""
SELECT IF(r.r_name = 'AMERICA', 'home', 'abroad') AS market, COUNT(DISTINCT c.c_custkey) AS n_customers,
       COUNT(DISTINCT c.c_nationkey) AS n_nations
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1
""")
def customers_home_region(spark, sf_dir, home: str = "AMERICA"):
    """Customers inside / outside one region, distinct counts per label."""
    t = Tables(spark, sf_dir)
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    region = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    j = (t.customer.select("c_custkey", "c_nationkey")
         .join(broadcast_if_small(nation), "c_nationkey")
         .join(broadcast_if_small(region), "n_regionkey"))
    market = two_way(F.col("r_name") == home, F.lit("home"), F.lit("abroad"))
    return j.groupBy(market.alias("market")).agg(F.countDistinct("c_custkey").alias("n_customers"),
                                                 F.countDistinct("c_nationkey").alias("n_nations"))


@report("distinct_keys_per_table", ops=("A3", "A10"), sql="""
SELECT (SELECT COUNT(DISTINCT c_custkey) FROM customer) AS n_customers,
       (SELECT COUNT(DISTINCT o_custkey) FROM orders) AS n_ordering_customers,
       (SELECT COUNT(DISTINCT user_id) FROM events) AS n_active_users
""")
def distinct_keys_per_table(spark, sf_dir):
    """How many distinct customers each table mentions."""
    t = Tables(spark, sf_dir)
    n_orders = t.orders.agg(F.countDistinct("o_custkey")).scalar()
    n_events = t.events.agg(F.countDistinct("user_id")).scalar()
    return t.customer.agg(F.countDistinct("c_custkey").alias("n_customers")).select(
        "n_customers", n_orders.alias("n_ordering_customers"), n_events.alias("n_active_users"))


@report("sql_ordinals_lateral_alias", ops=("P8", "A12", "A13", "O3", "A16", "S2"), sql="""
SELECT l_suppkey, COUNT(DISTINCT CAST(l_shipdate AS DATE)) AS num_days,
       CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS revenue_cents,
       CAST(revenue_cents AS DOUBLE) / 100 / num_days AS daily_revenue
FROM lineitem
WHERE l_returnflag <> 'R'
GROUP BY 1
HAVING num_days >= 20
ORDER BY 4 DESC, 1
""")
def sql_ordinals_lateral_alias(spark, sf_dir):
    """The SQL face: GROUP BY / ORDER BY ordinals, a lateral column alias reused in the
    same SELECT, HAVING on an alias."""
    register_views(spark, sf_dir, ["lineitem"])
    return spark.sql("""
        SELECT l_suppkey, COUNT(DISTINCT CAST(l_shipdate AS DATE)) AS num_days,
               SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS revenue_cents,
               CAST(revenue_cents AS DOUBLE) / 100 / num_days AS daily_revenue
        FROM lineitem
        WHERE l_returnflag <> 'R'
        GROUP BY 1
        HAVING num_days >= 20
        ORDER BY 4 DESC, 1""")


@report("events_per_type_month", ops=("A12", "X5", "A11"), sql="""
SELECT event_type, CAST(month(ts) AS INTEGER) AS event_month, COUNT(*) AS n_events
FROM events GROUP BY 1, 2
""")
def events_per_type_month(spark, sf_dir):
    """Counts per name and month: grouping on a derived date part."""
    e = Tables(spark, sf_dir).events
    return e.groupBy("event_type", F.month("ts").alias("event_month")).agg(F.count(F.lit(1)).alias("n_events"))


# Nation groups for the IN-list labelling report.
NATION_GROUP_1 = ["NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4"]
NATION_GROUP_2 = ["NATION_5", "NATION_6", "NATION_7", "NATION_8", "NATION_9"]
NATION_GROUP_3 = ["NATION_10", "NATION_11", "NATION_12"]


@report("nation_groups", ops=("X14", "F4", "A3", "J2"), sql="""
SELECT CASE WHEN n.n_name IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4') THEN 'Group 1'
            WHEN n.n_name IN ('NATION_5', 'NATION_6', 'NATION_7', 'NATION_8', 'NATION_9') THEN 'Group 2'
            WHEN n.n_name IN ('NATION_10', 'NATION_11', 'NATION_12') THEN 'Group 3'
            ELSE 'Group 4' END AS nation_group,
       COUNT(DISTINCT c.c_custkey) AS n_customers
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1
""")
def nation_groups(spark, sf_dir):
    """Labels from IN lists with an else group, consistently spelled."""
    t = Tables(spark, sf_dir)
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = t.customer.select("c_custkey", "c_nationkey").join(broadcast_if_small(nation), "c_nationkey")
    n = F.col("n_name")
    label = (F.when(n.isin(NATION_GROUP_1), "Group 1").when(n.isin(NATION_GROUP_2), "Group 2")
             .when(n.isin(NATION_GROUP_3), "Group 3").otherwise("Group 4"))
    return j.groupBy(label.alias("nation_group")).agg(F.countDistinct("c_custkey").alias("n_customers"))


@report("segment_purity_orders", ops=("X15", "X13", "A17", "J2"), sql="""
WITH per_cust AS (SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey)
SELECT CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'vehicles' WHEN 'MACHINERY' THEN 'vehicles'
            ELSE 'other' END AS segment_kind,
       COUNT(*) AS n_customers, AVG(p.n_orders) AS avg_orders
FROM customer c JOIN per_cust p ON c.c_custkey = p.o_custkey
GROUP BY 1
""")
def segment_purity_orders(spark, sf_dir):
    """A simple-CASE grouping label, then the average of a per-entity count."""
    t = Tables(spark, sf_dir)
    per_cust = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    kind = map_values("c_mktsegment", {"AUTOMOBILE": "vehicles", "MACHINERY": "vehicles"}, "other")
    j = t.customer.select("c_custkey", "c_mktsegment").join(per_cust, "c_custkey")
    return j.groupBy(kind.alias("segment_kind")).agg(F.count(F.lit(1)).alias("n_customers"),
                                                     F.avg("n_orders").alias("avg_orders"))


@report("year_weekday_clean_users", ops=("J13", "D7", "F11", "X7", "A12"), sql="""
SELECT CAST(year(e.ts) AS INTEGER) AS event_year, dayname(e.ts) AS weekday, COUNT(*) AS n_events
FROM events e
JOIN (SELECT DISTINCT c_custkey FROM customer WHERE NOT (c_acctbal < 0)) c ON e.user_id = c.c_custkey
WHERE e.event_type IS NULL OR e.event_type <> 'error'
GROUP BY 1, 2
""")
def year_weekday_clean_users(spark, sf_dir):
    """Events per year and weekday for de-duplicated, non-test users, flagged events
    removed NULL-tolerantly."""
    t = Tables(spark, sf_dir)
    clean = t.customer.filter(~(F.col("c_acctbal") < 0)).select(F.col("c_custkey").alias("user_id")).distinct()
    # One row per user, year and weekday before the join: a hot user is a few rows.
    e = t.events.filter(not_flagged("event_type", "error")).groupBy(
        "user_id", F.year("ts").alias("event_year"), weekday_name("ts").alias("weekday")).agg(
            F.count(F.lit(1)).alias("n_events"))
    return e.join(clean, "user_id").groupBy("event_year", "weekday").agg(F.sum("n_events").alias("n_events"))


@report("customers_ordering_after", ops=("A3", "F8", "A1"), sql="""
SELECT COUNT(DISTINCT o_custkey) AS n_customers, COUNT(*) AS n_orders
FROM orders WHERE o_orderdate > TIMESTAMP '1998-03-01'
""")
def customers_ordering_after(spark, sf_dir, cutoff: str = "1998-03-01"):
    """Distinct customers and orders after a date literal; the date reaches the scan."""
    o = Tables(spark, sf_dir).orders.filter(after("o_orderdate", cutoff))
    return o.agg(F.countDistinct("o_custkey").alias("n_customers"), F.count(F.lit(1)).alias("n_orders"))


@report("value_stats_one_type", ops=("A6", "F1", "A10"), sql="""
SELECT COUNT(*) AS n_events, ROUND(AVG(value), 6) AS avg_value, MIN(value) AS min_value,
       MAX(value) AS max_value, MIN(ts) AS first_ts, MAX(ts) AS last_ts
FROM events WHERE event_type = 'purchase'
""")
def value_stats_one_type(spark, sf_dir, event_type: str = "purchase"):
    """Mean, minimum and maximum of a measure and of a timestamp for one subgroup."""
    e = Tables(spark, sf_dir).events.filter(F.col("event_type") == event_type)
    return e.agg(F.count(F.lit(1)).alias("n_events"), F.round(F.avg("value"), 6).alias("avg_value"),
                 F.min("value").alias("min_value"), F.max("value").alias("max_value"),
                 F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@report("customers_per_nation_segment", ops=("A3", "A13", "O2", "J2"), sql=f"""
SELECT c.c_nationkey, c.c_mktsegment, COUNT(DISTINCT o.o_custkey) AS n_customers
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_nationkey, c.c_mktsegment
HAVING COUNT(DISTINCT o.o_custkey) >= 12
ORDER BY c.c_nationkey ASC, n_customers DESC
""")
def customers_per_nation_segment(spark, sf_dir, min_customers: int = 12):
    """Ordering customers per (nation, segment), groups with enough of them, sorted
    ascending then descending.  Orders are first reduced to distinct customers."""
    t = Tables(spark, sf_dir)
    buyers = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    j = buyers.join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment").distinct(), "c_custkey")
    return (j.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n_customers"))
            .filter(F.col("n_customers") >= min_customers)
            .orderBy(F.asc("c_nationkey"), F.desc("n_customers")))


@report("quarterly_quantity_pivot", ops=("A14", "A12", "X6"), sql="""
SELECT l_suppkey,
       SUM(CASE WHEN quarter(l_shipdate) = 1 THEN l_quantity END) AS q1,
       SUM(CASE WHEN quarter(l_shipdate) = 2 THEN l_quantity END) AS q2,
       SUM(CASE WHEN quarter(l_shipdate) = 3 THEN l_quantity END) AS q3,
       SUM(CASE WHEN quarter(l_shipdate) = 4 THEN l_quantity END) AS q4
FROM lineitem WHERE l_returnflag <> 'R'
GROUP BY l_suppkey
""")
def quarterly_quantity_pivot(spark, sf_dir):
    """Items sold per store and quarter, one column per quarter, with Spark's pivot.

    The pivot values are given up front, so Spark needs no extra job to find
    them.  It plans the pivot as an aggregation per (store, quarter) followed
    by a PivotFirst per store - two shuffles, both after partial aggregation.
    The hand-written conditional aggregates of ``pivot_sums`` need one, which
    is why the period reports use those.
    """
    li = Tables(spark, sf_dir).lineitem.filter(F.col("l_returnflag") != "R")
    wide = (li.withColumn("quarter", F.quarter("l_shipdate")).groupBy("l_suppkey")
            .pivot("quarter", [1, 2, 3, 4]).agg(F.sum("l_quantity")))
    return wide.select("l_suppkey", *[F.col(str(q)).alias(f"q{q}") for q in (1, 2, 3, 4)])
