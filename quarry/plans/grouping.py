"""Aggregation reports: counts, grouped/conditional/two-stage aggregates, spreads,
labels and durations.

Skew note: every aggregate here is algebraic (count, sum, min, max, avg,
stddev) or has a bounded per-group state (exact median over whole-unit
quantities), so Spark's map-side partial aggregation collapses a hot group
before the shuffle; no group is ever gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import Bin, after, bin_by, map_values, two_way, whole_units_between
from quarry.functions.arith import ratio
from quarry.operators import attr, broadcast_if_small, cents, representative, with_total
from quarry.plans.basics import SEG_SQL, segment_with_gaps
from quarry.plans.registry import report
from quarry.sources import Tables


def money_avg(col):
    """Mean of a two-decimal money column from an exact cents sum (order-independent)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(F.round(c * 100).cast("long")).cast("double") / F.lit(100) / F.count(c)


def _money_avg_sql(col):
    return f"CAST(SUM(CAST(ROUND({col} * 100) AS BIGINT)) AS DOUBLE) / 100 / COUNT({col})"


# --------------------------------------------------------------------------- counts


@report("counts_all_kinds", ops=("A1", "A2", "A3", "A5", "A10", "X12", "J5"), sql="""
SELECT COUNT(*) AS n_rows, COUNT(l.quality) AS n_quality, COUNT(DISTINCT d.lang) AS n_langs,
       COUNT(DISTINCT l.quality) AS n_quality_values,
       COUNT(*) FILTER (WHERE l.quality IS NULL) AS n_quality_null,
       CAST(SUM(CAST(l.quality IS NULL AS INTEGER)) AS BIGINT) AS n_quality_null_sum
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def counts_all_kinds(spark, sf_dir):
    """COUNT(*), COUNT(col), COUNT(DISTINCT), SUM(ISNULL()) in one pass."""
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "lang")
    j = d.join(broadcast_if_small(t.labels.select("doc_id", "quality")), "doc_id", "left")
    # Pre-aggregate to (lang, quality) combinations - a handful of rows per task
    # after map-side combine - so the two distinct counts expand that small
    # table instead of every document row.
    combos = j.groupBy("lang", "quality").agg(F.count(F.lit(1)).alias("n"))
    return combos.agg(F.sum("n").alias("n_rows"),
                      F.sum(F.when(F.col("quality").isNotNull(), F.col("n")).otherwise(0)).alias("n_quality"),
                      F.countDistinct("lang").alias("n_langs"),
                      F.countDistinct("quality").alias("n_quality_values"),
                      F.sum(F.when(F.col("quality").isNull(), F.col("n")).otherwise(0)).alias("n_quality_null"),
                      F.sum(F.when(F.isnull("quality"), F.col("n")).otherwise(0)).cast("long")
                      .alias("n_quality_null_sum"))


@report("group_multi_having", ops=("A11", "A13", "O2", "A6"), sql="""
SELECT l_suppkey, l_returnflag, COUNT(*) AS n_lines, SUM(l_quantity) AS sum_qty, AVG(l_quantity) AS avg_qty,
       MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship
FROM lineitem GROUP BY l_suppkey, l_returnflag
HAVING COUNT(*) >= 190 AND AVG(l_quantity) > 25
ORDER BY l_suppkey, n_lines DESC
""")
def group_multi_having(spark, sf_dir, min_lines: int = 190, min_avg_qty: float = 25.0):
    """Grouping by two keys with a two-condition HAVING, mixed-direction sort."""
    li = Tables(spark, sf_dir).lineitem
    return (li.groupBy("l_suppkey", "l_returnflag")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty"),
                 F.avg("l_quantity").alias("avg_qty"), F.min("l_shipdate").alias("first_ship"),
                 F.max("l_shipdate").alias("last_ship"))
            .filter((F.col("n_lines") >= min_lines) & (F.col("avg_qty") > min_avg_qty))
            .orderBy("l_suppkey", F.desc("n_lines")))


@report("group_null_key", ops=("A19", "A3"), sql=f"""
SELECT {SEG_SQL} AS seg, COUNT(*) AS n_customers, COUNT(DISTINCT c_nationkey) AS n_nations
FROM customer GROUP BY 1
""")
def group_null_key(spark, sf_dir):
    """NULL keys form one group."""
    c = Tables(spark, sf_dir).customer
    return c.groupBy(segment_with_gaps().alias("seg")).agg(
        F.count(F.lit(1)).alias("n_customers"), F.countDistinct("c_nationkey").alias("n_nations"))


@report("total_and_groups", ops=("A23", "A11"), sql="""
SELECT c_mktsegment, COUNT(*) AS n_customers, CAST(SUM(CAST(ROUND(c_acctbal * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_balance,
       CAST(GROUPING(c_mktsegment) AS BIGINT) AS is_total
FROM customer GROUP BY ROLLUP (c_mktsegment)
""")
def total_and_groups(spark, sf_dir):
    """Per-segment rows and the overall total in one query, via ROLLUP."""
    c = Tables(spark, sf_dir).customer
    out = with_total(c, ["c_mktsegment"], [F.count(F.lit(1)).alias("n_customers"),
                                           (F.sum(cents("c_acctbal")).cast("double") / 100).alias("total_balance")])
    return out.withColumn("is_total", F.col("is_total").cast("long"))


# --------------------------------------------------------------------------- two-stage, spread


@report("agg_of_agg_orders_per_customer", ops=("A17", "A18", "J1", "A7"), sql="""
WITH per_cust AS (SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey)
SELECT c.c_mktsegment, COUNT(*) AS n_customers, AVG(p.n_orders) AS avg_orders,
       ROUND(stddev_pop(p.n_orders), 6) AS std_orders, MAX(p.n_orders) AS max_orders
FROM customer c JOIN per_cust p ON c.c_custkey = p.o_custkey
GROUP BY c.c_mktsegment
""")
def agg_of_agg_orders_per_customer(spark, sf_dir):
    """Orders per customer, then mean/spread per segment."""
    t = Tables(spark, sf_dir)
    per_cust = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    j = t.customer.select("c_custkey", "c_mktsegment").join(
        per_cust, F.col("c_custkey") == F.col("o_custkey"))
    return j.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_customers"), F.avg("n_orders").alias("avg_orders"),
        F.round(F.stddev_pop("n_orders"), 6).alias("std_orders"), F.max("n_orders").alias("max_orders"))


@report("spread_by_group", ops=("A6", "A7", "A8", "A9", "A22", "D11", "J2"), sql="""
SELECT p.p_type, COUNT(*) AS n_lines, AVG(l.l_quantity) AS qty_avg,
       ROUND(stddev_pop(l.l_quantity), 6) AS qty_std_pop, ROUND(stddev_samp(l.l_quantity), 6) AS qty_std_samp,
       median(l.l_quantity) AS qty_median,
       ROUND(stddev_pop(l.l_quantity) / AVG(l.l_quantity), 6) AS qty_cv,
       CAST(stddev_pop(l.l_quantity) / AVG(l.l_quantity) > 0.5 AS INTEGER) AS unreliable_mean
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_type
""")
def spread_by_group(spark, sf_dir, cv_limit: float = 0.5):
    """Mean, population and sample spread, median, and a mean-reliability flag per department.

    The fact is reduced to counts per (sku, quantity) before it meets the
    department, then to counts per (department, quantity); the statistics are
    weighted by those counts.  Quantities are whole numbers 1-50, so a
    department has a bounded number of rows and all sums are exact.
    """
    t = Tables(spark, sf_dir)
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    counts = t.lineitem.groupBy("l_partkey", "l_quantity").agg(F.count(F.lit(1)).alias("n"))
    per_type = counts.join(broadcast_if_small(part), "l_partkey").groupBy("p_type", "l_quantity").agg(
        F.sum("n").alias("n"))
    q, n = F.col("l_quantity"), F.when(F.col("l_quantity").isNotNull(), F.col("n"))
    out = per_type.groupBy("p_type").agg(
        F.sum("n").alias("n_lines"), F.sum(n).alias("known"), F.sum(q * n).alias("total"),
        F.sum(q * q * n).alias("squares"),
        F.expr("percentile(l_quantity, 0.5, n)").alias("qty_median"))
    out = out.withColumn("qty_avg", ratio("total", "known")).withColumn(
        "deviation", F.greatest(F.col("squares") - F.col("total") * F.col("total") / F.col("known"), F.lit(0.0)))
    std_pop = F.sqrt(ratio("deviation", "known"))
    cv = std_pop / F.col("qty_avg")
    return out.select(
        "p_type", "n_lines", "qty_avg", F.round(std_pop, 6).alias("qty_std_pop"),
        F.round(F.sqrt(ratio("deviation", F.col("known") - 1)), 6).alias("qty_std_samp"), "qty_median",
        F.round(cv, 6).alias("qty_cv"), (cv > cv_limit).cast("int").alias("unreliable_mean"))


@report("attr_and_representative", ops=("A20", "A21"), sql="""
SELECT l_orderkey, COUNT(*) AS n_lines,
       CASE WHEN MIN(l_linestatus) = MAX(l_linestatus) AND COUNT(l_linestatus) = COUNT(*)
            THEN MIN(l_linestatus) END AS status_if_constant,
       min(struct_pack(a := l_linenumber, b := l_partkey)).b AS first_line_part
FROM lineitem GROUP BY l_orderkey
""")
def attr_and_representative(spark, sf_dir):
    """Deterministic replacements for a loose GROUP BY column:
    the value when constant within the group, and the value of the first line."""
    li = Tables(spark, sf_dir).lineitem
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), attr("l_linestatus").alias("status_if_constant"),
        representative("l_partkey", "l_linenumber").alias("first_line_part"))


# --------------------------------------------------------------------------- labels and bins


@report("if_case_equivalence", ops=("X13", "X14", "X15", "A12"), sql=f"""
WITH c AS (SELECT {SEG_SQL} AS seg FROM customer)
SELECT seg,
       IF(seg = 'BUILDING', 'construction', IF(seg = 'MACHINERY', 'industrial', 'other')) AS label_if,
       CASE WHEN seg = 'BUILDING' THEN 'construction' WHEN seg = 'MACHINERY' THEN 'industrial'
            ELSE 'other' END AS label_case,
       CASE seg WHEN 'BUILDING' THEN 'construction' WHEN 'MACHINERY' THEN 'industrial'
            ELSE 'other' END AS label_simple,
       COUNT(*) AS n_customers
FROM c GROUP BY 1, 2, 3, 4
""")
def if_case_equivalence(spark, sf_dir):
    """Nested IF = searched CASE = simple CASE, NULL falling to the else branch."""
    c = Tables(spark, sf_dir).customer.select(segment_with_gaps().alias("seg"))
    seg = F.col("seg")
    label_if = two_way(seg == "BUILDING", F.lit("construction"),
                       two_way(seg == "MACHINERY", F.lit("industrial"), F.lit("other")))
    label_case = F.when(seg == "BUILDING", "construction").when(seg == "MACHINERY", "industrial") \
        .otherwise("other")
    label_simple = map_values(seg, {"BUILDING": "construction", "MACHINERY": "industrial"}, "other")
    return c.groupBy("seg", label_if.alias("label_if"), label_case.alias("label_case"),
                     label_simple.alias("label_simple")).agg(F.count(F.lit(1)).alias("n_customers"))


# Balance classes with closed upper edges, negatives outside every class.
BALANCE_BINS = [
    Bin("low", 0, 2500),
    Bin("medium", 2500, 5000, lo_closed=False),
    Bin("high", 5000, 7500, lo_closed=False),
    Bin("very high", 7500, None, lo_closed=False),
]


@report("bin_balance", ops=("X16", "A11", "A6"), sql=f"""
WITH c AS (
  SELECT c_acctbal, CASE WHEN c_acctbal >= 0 AND c_acctbal <= 2500 THEN 'low'
                         WHEN c_acctbal > 2500 AND c_acctbal <= 5000 THEN 'medium'
                         WHEN c_acctbal > 5000 AND c_acctbal <= 7500 THEN 'high'
                         WHEN c_acctbal > 7500 THEN 'very high'
                         ELSE 'out_of_range' END AS balance_class
  FROM customer
)
SELECT balance_class, COUNT(*) AS n_customers, {_money_avg_sql('c_acctbal')} AS avg_balance,
       MIN(c_acctbal) AS min_balance, MAX(c_acctbal) AS max_balance
FROM c GROUP BY balance_class
""")
def bin_balance(spark, sf_dir):
    """Range classes with an else label, then per-class statistics."""
    c = Tables(spark, sf_dir).customer
    return c.groupBy(bin_by("c_acctbal", BALANCE_BINS, "out_of_range").alias("balance_class")).agg(
        F.count(F.lit(1)).alias("n_customers"), money_avg("c_acctbal").alias("avg_balance"),
        F.min("c_acctbal").alias("min_balance"), F.max("c_acctbal").alias("max_balance"))


@report("segment_early_late", ops=("Q3", "S4", "X13", "A6", "A12"), sql="""
WITH first_order AS (SELECT o_custkey, MIN(o_orderdate) AS first_date FROM orders GROUP BY o_custkey)
SELECT c.c_mktsegment,
       IF(f.first_date < TIMESTAMP '1995-06-01', 'early', 'late') AS cohort,
       COUNT(*) AS n_customers
FROM customer c JOIN first_order f ON c.c_custkey = f.o_custkey
GROUP BY 1, 2
""")
def segment_early_late(spark, sf_dir, cutoff: str = "1995-06-01"):
    """Customers labelled early/late by their first order, counted per segment."""
    t = Tables(spark, sf_dir)
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_date"))
    j = t.customer.select("c_custkey", "c_mktsegment").join(first, F.col("c_custkey") == F.col("o_custkey"))
    cohort = two_way(after("first_date", cutoff) | (F.col("first_date") == F.lit(cutoff).cast("timestamp_ntz")),
                     F.lit("late"), F.lit("early"))
    return j.groupBy("c_mktsegment", cohort.alias("cohort")).agg(F.count(F.lit(1)).alias("n_customers"))


# --------------------------------------------------------------------------- durations

_MINUTES_SQL = "date_sub('minute', o.o_orderdate, l.l_shipdate)"


def _durations(t: Tables):
    """lineitem ⋈ orders with the whole minutes from order to shipment.

    A fact-to-fact equi-join.  Where both tables have a current copy bucketed on
    the order key, it runs bucket by bucket; else both sides shuffle on it, and
    AQE splits a skewed order key on the lineitem side.
    """
    o = t.by_key("orders", "o_orderkey").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = t.by_key("lineitem", "l_orderkey").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate").join(o, "l_orderkey")
    return j.withColumn("minutes", whole_units_between("MINUTE", "o_orderdate", "l_shipdate"))


@report("duration_minutes_stats", ops=("X9", "A6", "F14"), sql=f"""
SELECT l.l_returnflag, COUNT(*) AS n_lines, AVG({_MINUTES_SQL}) AS avg_minutes,
       MIN({_MINUTES_SQL}) AS min_minutes, MAX({_MINUTES_SQL}) AS max_minutes
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE {_MINUTES_SQL} > 0
GROUP BY l.l_returnflag
""")
def duration_minutes_stats(spark, sf_dir):
    """Mean/min/max whole-minute duration over positive durations only."""
    d = _durations(Tables(spark, sf_dir)).filter(F.col("minutes") > 0)
    return d.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"), F.avg("minutes").alias("avg_minutes"),
        F.min("minutes").alias("min_minutes"), F.max("minutes").alias("max_minutes"))


@report("negative_durations", ops=("D2", "D3", "F13", "F14", "X10", "A10"), sql=f"""
SELECT COUNT(*) FILTER (WHERE l.l_shipdate < o.o_orderdate) AS n_negative,
       MIN({_MINUTES_SQL}) AS min_minutes,
       COUNT(*) FILTER (WHERE {_MINUTES_SQL} = 0) AS n_zero_minutes,
       COUNT(*) FILTER (WHERE l.l_shipdate = o.o_orderdate) AS n_same_time,
       MAX(date_diff('day', o.o_orderdate, l.l_shipdate)) AS max_days,
       COUNT(*) AS n_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def negative_durations(spark, sf_dir):
    """End before start, and zero durations from truncation vs identical times."""
    d = _durations(Tables(spark, sf_dir))
    return d.agg(F.count_if(F.col("l_shipdate") < F.col("o_orderdate")).alias("n_negative"),
                 F.min("minutes").alias("min_minutes"),
                 F.count_if(F.col("minutes") == 0).alias("n_zero_minutes"),
                 F.count_if(F.col("l_shipdate") == F.col("o_orderdate")).alias("n_same_time"),
                 F.max(F.datediff("l_shipdate", "o_orderdate")).cast("long").alias("max_days"),
                 F.count(F.lit(1)).alias("n_lines"))


@report("rows_above_average_duration", ops=("Q1", "Q5", "X9", "F14"), sql=f"""
SELECT l.l_orderkey, l.l_linenumber, {_MINUTES_SQL} AS minutes
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_returnflag = 'R'
  AND {_MINUTES_SQL} > (SELECT AVG({_MINUTES_SQL}) FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                        WHERE l.l_returnflag = 'R')
""")
def rows_above_average_duration(spark, sf_dir):
    """Rows whose duration exceeds the average, via a scalar subquery over the same
    fact-to-fact join; nothing is written in between."""
    d = (_durations(Tables(spark, sf_dir)).filter(F.col("l_returnflag") == "R")
         .select("l_orderkey", "l_linenumber", "minutes"))
    return d.filter(F.col("minutes") > d.agg(F.avg("minutes")).scalar())
