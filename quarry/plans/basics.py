"""Single-table reports: projection, filters, distinct, sort/paging, text and time parts.

Per-row arithmetic is left unrounded: the same IEEE operations on the same
inputs give the same bits in any engine.  Only order-dependent aggregates
are rounded, or computed from exact integers (cents, whole quantities).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import (WEEKDAYS_MONDAY_FIRST, ci_eq, ci_like, clean_label, drop_period,
                              in_period, not_blank, order_by_list, shift_hours, ts_literal,
                              weekday_name, weekday_number)
from quarry.operators import page, top_k
from quarry.plans.registry import report
from quarry.sources import Tables, register_views

# Segment rewrites that give the driver data NULLs and blanks
# (SURVEY 7.3): one segment becomes NULL, another the empty string.
NULL_SEGMENT = "HOUSEHOLD"
BLANK_SEGMENT = "FURNITURE"


def segment_with_gaps(col="c_mktsegment"):
    """c_mktsegment with one value turned NULL and one turned ''."""
    c = F.col(col)
    return F.when(c == NULL_SEGMENT, F.lit(None).cast("string")).when(c == BLANK_SEGMENT, F.lit("")) \
        .otherwise(c)


SEG_SQL = ("CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL WHEN c_mktsegment = 'FURNITURE' THEN '' "
           "ELSE c_mktsegment END")


@report("project_alias_arith", ops=("S1", "P1", "P3", "P4"), sql="""
SELECT l_orderkey, l_linenumber, l_quantity,
       l_extendedprice * (1 - l_discount) AS "net price",
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS "charge",
       l_quantity / 12 AS dozens
FROM lineitem
""")
def project_alias_arith(spark, sf_dir):
    """Chosen columns, derived arithmetic, aliases with spaces."""
    li = Tables(spark, sf_dir).lineitem
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", "l_quantity", net.alias("net price"),
                     (net * (1 + F.col("l_tax"))).alias("charge"),
                     (F.col("l_quantity") / 12).alias("dozens"))


@report("filter_compare_logic", ops=("F1", "F2", "F3", "F12", "F13", "A10"), sql="""
SELECT COUNT(*) FILTER (WHERE l_returnflag = 'R' AND l_quantity > 40 OR l_discount = 0) AS n_and_or,
       COUNT(*) FILTER (WHERE l_returnflag = 'R' AND (l_quantity > 40 OR l_discount = 0)) AS n_paren,
       COUNT(*) FILTER (WHERE NOT l_returnflag = 'R' AND l_quantity BETWEEN 10 AND 20) AS n_not_and,
       COUNT(*) FILTER (WHERE NOT (l_returnflag = 'R' AND l_quantity BETWEEN 10 AND 20)) AS n_not_paren,
       COUNT(*) FILTER (WHERE NOT (year(l_shipdate) = 1998 AND month(l_shipdate) = 8)) AS n_drop_period,
       COUNT(*) FILTER (WHERE l_linestatus <> 'O' AND l_discount <= 0.02) AS n_ne_le,
       COUNT(*) FILTER (WHERE l_tax > l_discount) AS n_col_cmp
FROM lineitem
""")
def filter_compare_logic(spark, sf_dir):
    """Comparison and logic operators with the NOT > AND > OR precedence made explicit."""
    li = Tables(spark, sf_dir).lineitem
    r, q, d = F.col("l_returnflag") == "R", F.col("l_quantity"), F.col("l_discount")
    return li.agg(
        F.count_if((r & (q > 40)) | (d == 0)).alias("n_and_or"),
        F.count_if(r & ((q > 40) | (d == 0))).alias("n_paren"),
        F.count_if((~r) & q.between(10, 20)).alias("n_not_and"),
        F.count_if(~(r & q.between(10, 20))).alias("n_not_paren"),
        F.count_if(drop_period("l_shipdate", 1998, 8)).alias("n_drop_period"),
        F.count_if((F.col("l_linestatus") != "O") & (d <= 0.02)).alias("n_ne_le"),
        F.count_if(F.col("l_tax") > d).alias("n_col_cmp"))


@report("filter_in_notin_null", ops=("F4", "F6", "F7"), sql=f"""
WITH c AS (SELECT {SEG_SQL} AS seg FROM customer)
SELECT COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE seg IN ('BUILDING', 'MACHINERY')) AS n_in,
       COUNT(*) FILTER (WHERE seg NOT IN ('BUILDING', 'MACHINERY')) AS n_not_in,
       COUNT(*) FILTER (WHERE seg IS NULL) AS n_null,
       COUNT(*) FILTER (WHERE seg IS NOT NULL) AS n_not_null,
       COUNT(*) FILTER (WHERE seg IS NOT NULL AND seg <> '') AS n_not_blank
FROM c
""")
def filter_in_notin_null(spark, sf_dir):
    """IN / NOT IN (NULL rows fall out of both), IS [NOT] NULL, blank vs NULL."""
    c = Tables(spark, sf_dir).customer.select(segment_with_gaps().alias("seg"))
    seg = F.col("seg")
    return c.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(seg.isin("BUILDING", "MACHINERY")).alias("n_in"),
                 F.count_if(~seg.isin("BUILDING", "MACHINERY")).alias("n_not_in"),
                 F.count_if(seg.isNull()).alias("n_null"),
                 F.count_if(seg.isNotNull()).alias("n_not_null"),
                 F.count_if(not_blank(seg)).alias("n_not_blank"))


@report("filter_like_ci", ops=("F5", "F10"), sql="""
SELECT p_partkey, p_name, p_type,
       CAST(p_name ILIKE '%RING%' AS INTEGER) AS has_ring,
       CAST(p_name ILIKE 's%' AS INTEGER) AS starts_s,
       CAST(p_name ILIKE '%T' AS INTEGER) AS ends_t,
       CAST(lower(p_type) = 'small' AS INTEGER) AS is_small
FROM part
WHERE p_name ILIKE '%RING%' OR p_name ILIKE 's%' OR p_name ILIKE '%T' OR lower(p_type) = 'small'
""")
def filter_like_ci(spark, sf_dir):
    """LIKE patterns and equality under case-insensitive matching."""
    p = Tables(spark, sf_dir).part
    flags = {"has_ring": ci_like("p_name", "%RING%"), "starts_s": ci_like("p_name", "s%"),
             "ends_t": ci_like("p_name", "%T"), "is_small": ci_eq("p_type", "small")}
    any_flag = flags["has_ring"] | flags["starts_s"] | flags["ends_t"] | flags["is_small"]
    return p.filter(any_flag).select("p_partkey", "p_name", "p_type",
                                     *[v.cast("int").alias(k) for k, v in flags.items()])


@report("filter_date_literal_parts", ops=("F8", "F9", "F15", "X5"), sql="""
SELECT o_orderkey, o_orderdate, dayname(o_orderdate) AS weekday, CAST(day(o_orderdate) AS INTEGER) AS day_of_month
FROM orders
WHERE o_orderdate > TIMESTAMP '1997-02-04' AND year(o_orderdate) = 1997
  AND (dayname(o_orderdate) = 'Tuesday' OR day(o_orderdate) > 15)
""")
def filter_date_literal_parts(spark, sf_dir):
    """Date literal comparison and date-part predicates.

    The year test is a timestamp range, so it reaches the Parquet scan.
    """
    o = Tables(spark, sf_dir).orders
    return (o.filter((F.col("o_orderdate") > ts_literal("1997-02-04")) & in_period("o_orderdate", 1997)
                     & ((weekday_name("o_orderdate") == "Tuesday") | (F.dayofmonth("o_orderdate") > 15)))
            .select("o_orderkey", "o_orderdate", weekday_name("o_orderdate").alias("weekday"),
                    F.dayofmonth("o_orderdate").alias("day_of_month")))


@report("distinct_combinations", ops=("P7", "O1"), sql=f"""
SELECT DISTINCT {SEG_SQL} AS seg, c_nationkey FROM customer
""")
def distinct_combinations(spark, sf_dir):
    """Unique (segment, nation) combinations; the NULL segment is one value."""
    c = Tables(spark, sf_dir).customer
    return (c.select(segment_with_gaps().alias("seg"), "c_nationkey").distinct()
            .orderBy(F.col("seg").asc_nulls_first(), "c_nationkey"))


@report("page_offset", ops=("O4", "O5"), sql="""
SELECT c_custkey, c_name, c_nationkey FROM customer ORDER BY c_custkey NULLS FIRST LIMIT 10 OFFSET 5
""")
def page_offset(spark, sf_dir):
    """Rows 6-15 in key order: LIMIT 10 OFFSET 5."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_nationkey")
    return page(c, [F.col("c_custkey")], offset=5, n=10)


@report("topk_first_orders", ops=("O3", "O6"), sql="""
SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate NULLS FIRST, o_orderkey LIMIT 10
""")
def topk_first_orders(spark, sf_dir):
    """The first ten orders ever, key as tie-break."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return top_k(o, 10, [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()])


@report("text_replace_trim_upper", ops=("X1", "X2", "X3", "D8", "P7"), sql="""
SELECT DISTINCT o_orderpriority,
       replace(o_orderpriority, '-', ' ') AS priority_words,
       ltrim(o_orderpriority, '0123456789-') AS priority_name,
       upper(lower(ltrim(o_orderpriority, '0123456789-'))) AS priority_upper
FROM orders
""")
def text_replace_trim_upper(spark, sf_dir):
    """REPLACE, TRIM(LEADING … FROM …), UPPER on a label column."""
    o = Tables(spark, sf_dir).orders.select("o_orderpriority").distinct()
    name = clean_label("o_orderpriority", strip_leading="0123456789-")
    return o.select("o_orderpriority",
                    clean_label("o_orderpriority", replace=("-", " ")).alias("priority_words"),
                    name.alias("priority_name"),
                    clean_label(F.lower(name), upper=True).alias("priority_upper"))


@report("clean_part_names", ops=("X1", "X2", "X3", "D8", "P7"), sql="""
SELECT DISTINCT p_name, upper(p_name) AS name_upper, replace(p_name, ' ', '-') AS name_dashed,
       ltrim(p_brand, 'Brand#') AS brand_number
FROM part
""")
def clean_part_names(spark, sf_dir):
    """Distinct cleaned labels: upper-case, replaced separators, stripped prefix."""
    p = Tables(spark, sf_dir).part.select("p_name", "p_brand")
    return p.select("p_name", F.upper("p_name").alias("name_upper"),
                    clean_label("p_name", replace=(" ", "-")).alias("name_dashed"),
                    clean_label("p_brand", strip_leading="Brand#").alias("brand_number")).distinct()


@report("weekday_per_row", ops=("X7", "X8"), sql="""
SELECT event_id, ts, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday_num, dayname(ts) AS weekday
FROM events
""")
def weekday_per_row(spark, sf_dir):
    """Weekday number (1 = Sunday) and full name per row."""
    e = Tables(spark, sf_dir).events
    return e.select("event_id", "ts", weekday_number("ts").alias("weekday_num"),
                    weekday_name("ts").alias("weekday"))


@report("weekday_counts", ops=("X7", "X8", "A12", "A3"), sql="""
SELECT dayname(ts) AS weekday, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday_num,
       COUNT(*) AS n_events, COUNT(DISTINCT user_id) AS n_users
FROM events GROUP BY 1, 2
""")
def weekday_counts(spark, sf_dir):
    """Events and distinct users per weekday."""
    e = Tables(spark, sf_dir).events
    return e.groupBy(weekday_name("ts").alias("weekday"), weekday_number("ts").alias("weekday_num")) \
        .agg(F.count(F.lit(1)).alias("n_events"), F.countDistinct("user_id").alias("n_users"))


@report("year_weekday_shifted", ops=("X11", "D14", "O7", "X5", "X7"), sql="""
WITH s AS (SELECT ts - INTERVAL 6 HOUR AS local_ts FROM events WHERE event_type NOT IN ('error', 'signup'))
SELECT CAST(year(local_ts) AS INTEGER) AS local_year, dayname(local_ts) AS weekday,
       CAST(list_position(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'],
                          dayname(local_ts)) AS BIGINT) AS day_order,
       COUNT(*) AS n_events
FROM s GROUP BY 1, 2, 3
ORDER BY local_year, day_order
""")
def year_weekday_shifted(spark, sf_dir, hours: int = -6):
    """Events per year and weekday after a fixed UTC-6h shift, in calendar order."""
    e = Tables(spark, sf_dir).events.filter(~F.col("event_type").isin("error", "signup"))
    s = e.select(shift_hours("ts", hours).alias("local_ts"))
    wd = weekday_name("local_ts")
    return (s.groupBy(F.year("local_ts").alias("local_year"), wd.alias("weekday"),
                      order_by_list(wd, WEEKDAYS_MONDAY_FIRST).alias("day_order"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .orderBy("local_year", "day_order"))


@report("sql_select_star_views", ops=("S1", "S2", "P2", "F1", "F8"), sql="""
SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1998-01-01'
""")
def sql_select_star_views(spark, sf_dir):
    """The SQL face of the library: tables registered as views (``USE db`` / ``db.table``),
    then ``SELECT *`` with filters that reach the Parquet scan."""
    register_views(spark, sf_dir, ["orders"], qualified=True)
    return spark.sql("SELECT * FROM global_temp.orders "
                     "WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP_NTZ '1998-01-01'")
