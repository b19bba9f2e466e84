"""Join reports: inner (one and two keys), star, outer, semi/anti, dedupe-before-join,
fan-out and join-back (J1-J16).

Scale rules applied throughout:
* a fact table joined to a per-key question is first reduced to one row per
  key (count / distinct) with map-side partial aggregation, so a user holding
  a third of the events is one row by the time it is shuffled;
* a many-to-many join is answered from per-key aggregates (count x count,
  sums), never by materialising all pairs of a key;
* dimensions are hinted for broadcast only after their estimated size was
  checked (``broadcast_if_small``); otherwise the join stays a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import not_flagged
from quarry.operators import (anti, anti_by_outer_join, broadcast_if_small, cents, dedupe_join, fanout,
                              per_key, semi, top_k)
from quarry.plans.registry import report
from quarry.sources import Tables


def _events_per_user(t: Tables, event_type: str | None = None):
    e = t.events
    if event_type is not None:
        e = e.filter(F.col("event_type") == event_type)
    return e.groupBy(F.col("user_id")).agg(F.count(F.lit(1)).alias("n_events"))


@report("join_inner_two_keys", ops=("J1", "J2", "J3", "A6"), sql="""
WITH b AS (SELECT l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_returnflag <> 'R'),
     r AS (SELECT l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'R')
SELECT b.l_partkey, b.l_suppkey, COUNT(*) AS joined_rows,
       AVG(r.l_quantity) AS avg_returned_qty,
       AVG(b.l_quantity) AS avg_bought_qty
FROM b JOIN r ON b.l_partkey = r.l_partkey AND b.l_suppkey = r.l_suppkey
GROUP BY b.l_partkey, b.l_suppkey
""")
def join_inner_two_keys(spark, sf_dir):
    """Purchases matched to returns on both keys (part, supplier), averaged per pair.

    The pairwise join would emit n_bought x n_returned rows per pair; the same
    numbers come from one aggregate per side joined on the pair: the row count
    is the product of the counts and each side's mean is unchanged by the
    repetition.
    """
    li = Tables(spark, sf_dir).lineitem.select("l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    keys = ["l_partkey", "l_suppkey"]
    bought = (li.filter(F.col("l_returnflag") != "R").groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("n_b"), F.avg("l_quantity").alias("avg_bought_qty")))
    returned = (li.filter(F.col("l_returnflag") == "R").groupBy(*keys)
                .agg(F.count(F.lit(1)).alias("n_r"), F.avg("l_quantity").alias("avg_returned_qty")))
    j = bought.join(returned, keys, "inner")
    return j.select(*keys, (F.col("n_b") * F.col("n_r")).alias("joined_rows"),
                    "avg_returned_qty", "avg_bought_qty")


@report("join_star_four", ops=("J4", "A4", "A11"), sql="""
SELECT r.r_name, p.p_type, COUNT(*) AS n_lines,
       CAST(SUM(CAST(ROUND(l.l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, p.p_type
""")
def join_star_four(spark, sf_dir):
    """Fact joined through four dimensions, revenue per region and department.

    Eager aggregation: after the part lookup the fact is reduced to one row per
    (supplier, department) before the geography joins, so those joins see
    suppliers x departments rows instead of every line.  Each dimension is
    size-checked on its own (a pre-joined dimension gets a product-of-sizes
    estimate and would never qualify).
    """
    t = Tables(spark, sf_dir)
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    li = t.lineitem.select("l_partkey", "l_suppkey", cents("l_extendedprice").alias("cents"))
    per_supp = (li.join(broadcast_if_small(part), "l_partkey")
                .groupBy("l_suppkey", "p_type")
                .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("cents").alias("cents")))
    supp = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    nation = t.nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    region = t.region.select("r_regionkey", "r_name")
    j = (per_supp.join(broadcast_if_small(supp), "l_suppkey")
         .join(broadcast_if_small(nation), "n_nationkey")
         .join(broadcast_if_small(region), "r_regionkey"))
    return j.groupBy("r_name", "p_type").agg(
        F.sum("n_lines").alias("n_lines"),
        (F.sum("cents").cast("double") / F.lit(100)).alias("revenue"))


@report("join_left_counts", ops=("J5", "A2", "A19"), sql=f"""
SELECT c.c_custkey, c.c_mktsegment, COUNT(e.event_id) AS n_events
FROM customer c LEFT JOIN events e ON c.c_custkey = e.user_id
GROUP BY c.c_custkey, c.c_mktsegment
""")
def join_left_counts(spark, sf_dir):
    """Every customer with its number of events, zero included; a customer's
    repeated rows multiply its events, as the join does."""
    t = Tables(spark, sf_dir)
    per_user = t.events.groupBy("user_id").agg(F.count("event_id").alias("n_events"))
    c = per_key(t.customer, "c_custkey", "c_mktsegment")
    j = c.join(per_user, c["c_custkey"] == per_user["user_id"], "left")
    return j.select("c_custkey", "c_mktsegment",
                    (F.coalesce("n_events", F.lit(0)) * F.col("copies")).alias("n_events"))


@report("join_right", ops=("J6", "A2"), sql="""
SELECT c.c_nationkey, COUNT(*) AS n_customers, COUNT(e.user_id) AS n_with_events
FROM (SELECT DISTINCT user_id FROM events) e RIGHT JOIN customer c ON e.user_id = c.c_custkey
GROUP BY c.c_nationkey
""")
def join_right(spark, sf_dir):
    """RIGHT JOIN keeps every customer: with and without activity per nation."""
    t = Tables(spark, sf_dir)
    users = t.events.select("user_id").distinct()
    j = users.join(t.customer.select("c_custkey", "c_nationkey"),
                   F.col("user_id") == F.col("c_custkey"), "right")
    return j.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_customers"),
                                        F.count("user_id").alias("n_with_events"))


@report("join_full", ops=("J7", "X14"), sql="""
WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'),
     b AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT CASE WHEN a.user_id IS NOT NULL AND b.c_custkey IS NOT NULL THEN 'both'
            WHEN a.user_id IS NOT NULL THEN 'buyer_only' ELSE 'segment_only' END AS side,
       COUNT(*) AS n_keys
FROM a FULL OUTER JOIN b ON a.user_id = b.c_custkey
GROUP BY 1
""")
def join_full(spark, sf_dir):
    """FULL OUTER JOIN of buyers and one customer segment, classified by side."""
    t = Tables(spark, sf_dir)
    a = t.events.filter(F.col("event_type") == "purchase").select("user_id").distinct()
    b = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    j = a.join(b, a["user_id"] == b["c_custkey"], "full")
    side = (F.when(F.col("user_id").isNotNull() & F.col("c_custkey").isNotNull(), "both")
            .when(F.col("user_id").isNotNull(), "buyer_only").otherwise("segment_only"))
    return j.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n_keys"))


@report("anti_three_ways", ops=("J9", "J11", "J6", "F4"), sql="""
SELECT
  (SELECT COUNT(*) FROM customer c LEFT JOIN (SELECT DISTINCT user_id FROM events) e
     ON c.c_custkey = e.user_id WHERE e.user_id IS NULL) AS n_left_join,
  (SELECT COUNT(*) FROM (SELECT DISTINCT user_id FROM events) e RIGHT JOIN customer c
     ON e.user_id = c.c_custkey WHERE e.user_id IS NULL) AS n_right_join,
  (SELECT COUNT(*) FROM customer c WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey))
     AS n_not_exists,
  (SELECT COUNT(*) FROM customer c WHERE c.c_custkey NOT IN (SELECT user_id FROM events)) AS n_not_in
""")
def anti_three_ways(spark, sf_dir):
    """Customers without events, as LEFT JOIN/IS NULL, RIGHT JOIN/IS NULL, NOT EXISTS and
    NOT IN - identical counts."""
    t = Tables(spark, sf_dir)
    c, e = t.customer.select("c_custkey"), t.events.select("user_id")
    left = anti_by_outer_join(c, e, "c_custkey", "user_id", side="left")
    right = anti_by_outer_join(c, e, "c_custkey", "user_id", side="right")
    not_exists = anti(c, e.withColumnRenamed("user_id", "c_custkey"), "c_custkey")
    # NOT IN is NULL-aware: a NULL user_id would empty the result, unlike NOT EXISTS.
    # A NULL c_custkey is not known to be outside a set with members, so it drops out as well.
    not_in = c.join(e.distinct(), F.col("c_custkey") == F.col("user_id"), "left_anti")
    null_users = e.agg(F.count_if(F.col("user_id").isNull())).scalar()
    known = not_in.agg(F.count("c_custkey")).scalar()
    n_not_in = (F.when(null_users > 0, F.lit(0))
                .when(e.agg(F.count(F.lit(1))).scalar() == 0, c.agg(F.count(F.lit(1))).scalar())
                .otherwise(known))
    # One row; the other counts enter as scalar subqueries (each a one-row aggregate).
    return left.agg(F.count(F.lit(1)).alias("n_left_join")).select(
        "n_left_join",
        right.agg(F.count(F.lit(1))).scalar().alias("n_right_join"),
        not_exists.agg(F.count(F.lit(1))).scalar().alias("n_not_exists"),
        n_not_in.cast("long").alias("n_not_in"))


@report("semi_exists", ops=("J10", "Q2"), sql="""
SELECT c.c_custkey, c.c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey AND e.event_type = 'purchase')
""")
def semi_exists(spark, sf_dir):
    """Customers with at least one purchase event; no duplication."""
    t = Tables(spark, sf_dir)
    buyers = t.events.filter(F.col("event_type") == "purchase").select(F.col("user_id").alias("c_custkey"))
    return semi(t.customer.select("c_custkey", "c_name"), buyers, "c_custkey")


@report("dedupe_before_join", ops=("J13", "Q4", "J12"), sql="""
WITH first_orders AS (
  SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate NULLS FIRST, o_orderkey LIMIT 100
), lines AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
SELECT f.o_orderkey, f.o_custkey, COUNT(*) AS n_line_numbers,
       (SELECT COUNT(*) FROM lineitem li WHERE li.l_orderkey = f.o_orderkey) AS n_rows
FROM first_orders f JOIN lines l ON f.o_orderkey = l.l_orderkey
GROUP BY f.o_orderkey, f.o_custkey
""")
def dedupe_before_join(spark, sf_dir, first_n: int = 100):
    """The first orders joined to their *distinct* line numbers, with the raw row count
    for contrast: duplicate (order, line) rows do not multiply.

    The bounded left side (LIMIT) is broadcast, so only matching lines move.
    """
    t = Tables(spark, sf_dir)
    first = top_k(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), first_n,
                  [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]).select("o_orderkey", "o_custkey")
    # One join with the bounded side filters the fact and carries the customer along.
    lines = t.lineitem.select("l_orderkey", "l_linenumber").join(
        broadcast_if_small(first), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy("o_orderkey", "o_custkey").agg(
        F.countDistinct("l_linenumber").alias("n_line_numbers"), F.count(F.lit(1)).alias("n_rows"))


@report("join_fanout", ops=("J14", "D4"), sql="""
SELECT o.o_custkey AS key, COUNT(DISTINCT o.o_orderkey) AS n_left, COUNT(DISTINCT e.event_id) AS n_right,
       COUNT(*) AS n_pairs
FROM orders o JOIN events e ON o.o_custkey = e.user_id
GROUP BY o.o_custkey
""")
def join_fanout(spark, sf_dir):
    """Rows the orders-events join would produce per customer = orders x events."""
    t = Tables(spark, sf_dir)
    return fanout(t.orders, t.events, "o_custkey", "user_id", key_name="key")


@report("brand_unlisted_parts", ops=("J9", "J16", "A3", "O6"), sql=f"""
WITH unlisted AS (
  SELECT DISTINCT sold.l_partkey FROM lineitem sold
  WHERE NOT EXISTS (SELECT 1 FROM lineitem back WHERE back.l_returnflag = 'R'
                    AND back.l_partkey = sold.l_partkey AND back.l_suppkey = sold.l_suppkey))
SELECT brands.p_brand, COUNT(*) AS n_parts
FROM unlisted JOIN (SELECT DISTINCT p_partkey, p_brand FROM part) brands ON brands.p_partkey = unlisted.l_partkey
GROUP BY brands.p_brand
ORDER BY n_parts DESC, brands.p_brand
""")
def brand_unlisted_parts(spark, sf_dir):
    """Brand with most skus sold through (sku, store) pairs missing from the listing table,
    the listing being the pairs that had returns.

    Both facts of a pair - sold, and returned - come from one aggregate per
    pair; a pair with a NULL store is in no listing."""
    t = Tables(spark, sf_dir)
    pairs = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(
        F.coalesce(F.bool_or(F.col("l_returnflag") == "R"), F.lit(False)).alias("listed"))
    unlisted = pairs.filter(~F.col("listed") | F.col("l_suppkey").isNull()).select("l_partkey").distinct()
    brand = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand").distinct()
    return (unlisted.join(brand, "l_partkey").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_parts"))
            .orderBy(F.desc("n_parts"), "p_brand"))


@report("top_nations_by_active_customers", ops=("O6", "J13", "A3", "J4"), sql=f"""
SELECT n.n_name, COUNT(DISTINCT c.c_custkey) AS n_customers
FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
ORDER BY n_customers DESC, n.n_name
LIMIT 5
""")
def top_nations_by_active_customers(spark, sf_dir, k: int = 5):
    """Top nations by distinct active customers; both sides de-duplicated before the join."""
    t = Tables(spark, sf_dir)
    users = dedupe_join(t.events.select(F.col("user_id").alias("c_custkey")), t.customer, "c_custkey",
                        right_cols=["c_nationkey"])
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = users.join(broadcast_if_small(nations), "c_nationkey").select("c_custkey", "n_name").distinct()
    counts = j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_customers"))
    return top_k(counts, k, [F.desc("n_customers"), F.asc("n_name")])


@report("users_per_segment", ops=("J1", "A3", "A12"), sql=f"""
SELECT c.c_mktsegment, COUNT(DISTINCT e.user_id) AS n_users, COUNT(*) AS n_events
FROM events e JOIN customer c ON e.user_id = c.c_custkey
GROUP BY c.c_mktsegment
""")
def users_per_segment(spark, sf_dir):
    """Distinct active users, and joined rows, per customer segment; a user's
    repeated rows multiply the rows, not the users."""
    t = Tables(spark, sf_dir)
    per_user = _events_per_user(t)
    j = per_user.join(per_key(t.customer, "c_custkey", "c_mktsegment"), F.col("user_id") == F.col("c_custkey"))
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_users"),
                                         F.sum(F.col("n_events") * F.col("copies")).alias("n_events"))


@report("top_segments_by_events", ops=("J1", "A2", "O6"), sql="""
SELECT c.c_mktsegment, COUNT(e.event_id) AS n_events
FROM events e JOIN customer c ON e.user_id = c.c_custkey
WHERE e.event_type = 'click'
GROUP BY c.c_mktsegment
ORDER BY n_events DESC, c.c_mktsegment
LIMIT 3
""")
def top_segments_by_events(spark, sf_dir, k: int = 3):
    """Top segments by click activity."""
    t = Tables(spark, sf_dir)
    per_user = _events_per_user(t, "click")
    j = per_user.join(t.customer.select("c_custkey", "c_mktsegment"),
                      F.col("user_id") == F.col("c_custkey"))
    counts = j.groupBy("c_mktsegment").agg(F.sum("n_events").alias("n_events"))
    return top_k(counts, k, [F.desc("n_events"), F.asc("c_mktsegment")])


@report("orders_per_customer_label", ops=("J2", "X13", "A20", "J5"), sql=f"""
SELECT c.c_custkey, IF(c.c_acctbal > 5000, 'high balance', 'standard') AS balance_label,
       COUNT(o.o_orderkey) AS n_orders
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey, c.c_acctbal
""")
def orders_per_customer_label(spark, sf_dir):
    """Orders per customer with a label derived from a column of the grouped side."""
    t = Tables(spark, sf_dir)
    per_cust = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("n_orders"))
    j = per_key(t.customer, "c_custkey", "c_acctbal").join(per_cust, "c_custkey", "left")
    return j.select("c_custkey",
                    F.when(F.col("c_acctbal") > 5000, "high balance").otherwise("standard").alias("balance_label"),
                    (F.coalesce("n_orders", F.lit(0)) * F.col("copies")).alias("n_orders"))


@report("flag_not_excluded", ops=("F11", "J5", "P5", "P6"), sql="""
SELECT d.doc_id, d.lang, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.toxic IS NULL OR l.toxic = 0
""")
def flag_not_excluded(spark, sf_dir):
    """Documents not flagged toxic, NULL-tolerant: unlabelled documents stay.

    ``toxic != 1`` would silently drop every document without a label.  Table
    aliases qualify the shared ``doc_id``; an unqualified reference would be
    ambiguous.
    """
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "lang").alias("d")
    lab = broadcast_if_small(t.labels).alias("l")
    j = d.join(lab, F.col("d.doc_id") == F.col("l.doc_id"), "left")
    return j.filter(not_flagged(F.col("l.toxic"))).select(
        F.col("d.doc_id").alias("doc_id"), F.col("d.lang").alias("lang"),
        F.col("l.quality").alias("quality"), F.col("l.toxic").alias("toxic"))


@report("clean_join_counts", ops=("D7", "F11", "J13", "A1", "A3", "J2"), sql=f"""
WITH raw AS (SELECT c.c_custkey, c.c_acctbal, o.o_orderkey, o.o_orderstatus
             FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey)
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT c_custkey) AS n_customers,
       (SELECT COUNT(DISTINCT c_custkey) FROM raw
         WHERE NOT (c_acctbal < 0) AND (o_orderstatus IS NULL OR o_orderstatus <> 'P')) AS n_clean_customers,
       (SELECT COUNT(*) FROM raw
         WHERE NOT (c_acctbal < 0) AND (o_orderstatus IS NULL OR o_orderstatus <> 'P')) AS n_clean_rows
FROM raw
""")
def clean_join_counts(spark, sf_dir):
    """Join counts raw / distinct / with flagged rows removed on both sides:
    test accounts on the customer side, pending orders on the order side.

    Each side is reduced to one row per customer before the join - orders to
    counts, customers to their numbers of rows - so repeated customer rows
    multiply the joined rows and leave the distinct counts alone.
    """
    t = Tables(spark, sf_dir)
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    per_cust = o.groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(not_flagged("o_orderstatus", "P")).alias("n_clean_orders"))
    c = t.customer.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("copies"),
                                           F.count_if(~(F.col("c_acctbal") < 0)).alias("clean_copies"))
    j = c.join(per_cust, "c_custkey")
    rows, clean_rows = (F.col("copies") * F.col("n_orders"), F.col("clean_copies") * F.col("n_clean_orders"))
    return j.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_customers"),
                 F.count_if(clean_rows > 0).alias("n_clean_customers"),
                 F.coalesce(F.sum(clean_rows), F.lit(0)).alias("n_clean_rows"))
