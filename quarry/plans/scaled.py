"""Reports that need a mechanism of their own at scale: spines, mergeable distinct
counts, exact quantiles, exploding joins, deep pages and coverage (J5, J8, J14, A3, A22, O5, D9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import cents
from quarry.operators.coverage import LEAST_SHARE, month_coverage
from quarry.operators.distincts import bitmap_counts, bitmap_table, merged_profile, sketches
from quarry.operators.hot_keys import exploded_join
from quarry.operators.key_filter import filtered_semi
from quarry.operators.label_clusters import clusters
from quarry.operators.order_stats import exact_quantiles, page_of
from quarry.operators.spine import fill, month_spine
from quarry.plans.registry import report
from quarry.sources import Tables


@report("nation_month_spine", ops=("J8", "J5", "A12"), sql="""
WITH m AS (SELECT CAST(unnest(generate_series(date_trunc('month', MIN(o_orderdate)), date_trunc('month', MAX(o_orderdate)),
             INTERVAL 1 MONTH)) AS DATE) AS month FROM orders),
c AS (SELECT c_nationkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n_orders,
        SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS cents
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT n.n_name, m.month, COALESCE(c.n_orders, 0) AS n_orders, CAST(COALESCE(c.cents, 0) AS BIGINT) AS cents
FROM nation n CROSS JOIN m LEFT JOIN c ON c.c_nationkey = n.n_nationkey AND c.month = m.month
""")
def nation_month_spine(spark, sf_dir):
    """Orders per nation and calendar month, also the months in which a nation has none."""
    t = Tables(spark, sf_dir)
    spine = month_spine(t.nation.select("n_nationkey", "n_name"), t.orders, "o_orderdate")
    of = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    month = F.trunc("o_orderdate", "month").alias("month")
    counts = t.orders.join(of, "o_custkey").groupBy("n_nationkey", month).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(cents("o_totalprice")).alias("cents"))
    return fill(spine, counts, ["n_nationkey", "month"], ["n_orders", "cents"]).select(
        "n_name", "month", "n_orders", "cents")


def _ship_month():
    return F.date_format("l_shipdate", "yyyy-MM")


@report("distinct_by_month_and_total", ops=("A3", "A23", "X6"), sql="""
SELECT strftime(l_shipdate, '%Y-%m') AS period, COUNT(DISTINCT l_partkey) AS n_parts,
       COUNT(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY 1
UNION ALL
SELECT 'all', COUNT(DISTINCT l_partkey), COUNT(DISTINCT l_suppkey) FROM lineitem
""")
def distinct_by_month_and_total(spark, sf_dir):
    """Distinct parts and suppliers per month and in all, from one table of bitmaps."""
    ids = {"n_parts": "l_partkey", "n_suppliers": "l_suppkey"}
    by_month = bitmap_table(Tables(spark, sf_dir).lineitem, {"period": _ship_month()}, ids)
    total = bitmap_counts(by_month, list(ids)).select(F.lit("all").alias("period"), *ids)
    return bitmap_counts(by_month, list(ids), "period").unionByName(total)


_SKETCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice"]


@report("sketch_profile_lineitem", ops=("A3", "D1", "S3"), sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_nulls, true AS within_two_percent "
    f"FROM lineitem" for c in _SKETCHED))
def sketch_profile_lineitem(spark, sf_dir):
    """Profile from monthly sketches, and whether their union is within 2 % of the exact distinct counts."""
    fact = Tables(spark, sf_dir).lineitem.select("l_shipdate", *_SKETCHED)
    merged = merged_profile(sketches(fact.withColumn("month", _ship_month()), _SKETCHED, "month"))
    # Exact counts: each column's values as hashes, one row a value.
    values = fact.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias("v"))
        for c in _SKETCHED])).alias("s")).select("s.*").where("v IS NOT NULL").distinct()
    exact = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("exact"))
    off = F.abs(F.col("n_distinct") - F.coalesce("exact", F.lit(0)))
    return merged.join(exact, "column_name", "left").select(
        "column_name", "n_rows", "n_nulls", (off <= F.coalesce("exact", F.lit(0)) * 0.02).alias("within_two_percent"))


@report("exact_price_quantiles", ops=("A22", "D11", "A11"), sql="""
SELECT l_returnflag, s.share, CASE s.share WHEN 0.25 THEN a WHEN 0.5 THEN b ELSE c END AS price
FROM (SELECT l_returnflag, quantile_disc(l_extendedprice, 0.25) AS a, quantile_disc(l_extendedprice, 0.5) AS b,
             quantile_disc(l_extendedprice, 0.75) AS c FROM lineitem GROUP BY l_returnflag),
     (SELECT CAST(unnest([0.25, 0.5, 0.75]) AS DOUBLE) AS share) s
""")
def exact_price_quantiles(spark, sf_dir):
    """Exact quartiles of the line price per return flag: a continuous column, three huge groups."""
    out = exact_quantiles(Tables(spark, sf_dir).lineitem, ["l_returnflag"], "l_extendedprice", [0.25, 0.5, 0.75])
    return out.withColumnRenamed("value", "price")


@report("events_orders_exploded", ops=("J5", "J14"), sql="""
SELECT e.event_id, e.user_id, o.o_orderkey FROM events e LEFT JOIN orders o ON e.user_id = o.o_custkey
""")
def events_orders_exploded(spark, sf_dir, target_rows: int = 1_000_000):
    """Every event with every order of its user: all rows of the left join, hot users dealt out."""
    t = Tables(spark, sf_dir)
    return exploded_join(t.events.select("event_id", "user_id"), t.orders.select("o_custkey", "o_orderkey"),
                         "user_id", "o_custkey", "left", target_rows).select("event_id", "user_id", "o_orderkey")


@report("lines_page_500", ops=("O5", "O2"), sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST
LIMIT 10 OFFSET 4990
""")
def lines_page_500(spark, sf_dir, few_rows: int = 10_000):
    """Page 500 of ten lines each, in (order, line, part, supplier) order, without sorting the 499 before."""
    rows = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return page_of(rows, rows.columns, 4990, 10, few_rows)


@report("month_coverage", ops=("D9", "D10", "X6"), sql="""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, COUNT(DISTINCT CAST(l_shipdate AS DATE)) AS n_days,
       CAST(day(last_day(MIN(l_shipdate))) AS BIGINT) AS days_in_month,
       2 * COUNT(DISTINCT CAST(l_shipdate AS DATE)) >= day(last_day(MIN(l_shipdate))) AS is_whole
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1
""")
def month_coverage_report(spark, sf_dir):
    """Days with a sale per calendar month, and whether the month counts as whole."""
    return month_coverage(Tables(spark, sf_dir).lineitem, "l_shipdate").select(
        "month", "n_days", "days_in_month", (F.col("share") >= LEAST_SHARE).alias("is_whole"))


@report("host_label_clusters", ops=("D8", "X1", "X3", "A13"), sql=r"""
WITH RECURSIVE l AS (
  SELECT label, COUNT(*) AS n_rows, trim(regexp_replace(lower(label), '\s+', ' ', 'g')) AS t,
         array_to_string(list_sort(list_distinct(list_filter(string_split(regexp_replace(lower(label),
           '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: w <> ''))), ' ') AS mark
  FROM (SELECT regexp_extract(url, '//([^/?#]*)', 1) AS label FROM pages WHERE url IS NOT NULL) GROUP BY label),
e AS (SELECT a.label AS u, b.label AS v FROM l a JOIN l b ON a.label <> b.label AND a.mark <> '' AND b.mark <> ''
  AND (a.mark = b.mark OR (length(a.t) >= 5 AND length(b.t) >= 5 AND levenshtein(a.t, b.t) <= 1))),
r AS (SELECT label AS u, label AS v FROM l WHERE mark <> '' UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
c AS (SELECT u AS label, MIN(v) AS root FROM r GROUP BY u),
n AS (SELECT c.root, COUNT(*) AS cluster_labels, SUM(n_rows) AS cluster_rows,
        arg_min(label, (-n_rows, label)) AS cluster FROM c JOIN l USING (label) GROUP BY c.root)
SELECT l.label, l.n_rows, n.cluster, n.cluster_labels, CAST(n.cluster_rows AS BIGINT) AS cluster_rows
FROM l JOIN c USING (label) JOIN n USING (root)
""")
def host_label_clusters(spark, sf_dir):
    """Hosts of pages whose names are spellings of one another, with their pages."""
    hosts = Tables(spark, sf_dir).pages.where("url IS NOT NULL").select(
        F.regexp_extract("url", "//([^/?#]*)", 1).alias("label"))
    return clusters(hosts, "label")


@report("lines_of_large_urgent_orders", ops=("J10", "Q2", "A6"), sql="""
SELECT l.l_returnflag, COUNT(*) AS n_lines, SUM(CAST(ROUND(l.l_extendedprice * 100) AS BIGINT))::BIGINT AS cents
FROM lineitem l WHERE EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderpriority LIKE '1%' AND o.o_totalprice > 100000)
GROUP BY l.l_returnflag
""")
def lines_of_large_urgent_orders(spark, sf_dir):
    """Lines of urgent orders over 100,000: a semi-join whose misses are dropped before the shuffle."""
    t = Tables(spark, sf_dir)
    large = t.orders.where(F.col("o_orderpriority").startswith("1") & (F.col("o_totalprice") > 100_000)).select(
        F.col("o_orderkey").alias("l_orderkey"))
    lines = filtered_semi(t.lineitem.select("l_orderkey", "l_returnflag", "l_extendedprice"), large, "l_orderkey")
    return lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"),
                                             F.sum(cents("l_extendedprice")).alias("cents"))
