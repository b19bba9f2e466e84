"""Data-quality reports: profiles, duplicate keys, orphans, blanks, impossible values,
and the full-result export (S3, S5, D1-D13).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import blank_null_breakdown, duplicate_keys, orphan_keys, profile_table
from quarry.plans.basics import SEG_SQL, segment_with_gaps
from quarry.plans.registry import report
from quarry.session import delete_at_exit
from quarry.sources import SCHEMAS, Tables, export_folder, read_csv, write_csv

_EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _profile_sql(table: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_nulls, "
             f"COUNT({c}) AS n_non_null, COUNT(DISTINCT {c}) AS n_distinct FROM {table}" for c in cols]
    return "\nUNION ALL\n".join(parts)


@report("profile_events", ops=("S3", "D1", "D13", "A1", "A2", "A3"), sql=_profile_sql("events", _EVENT_COLS))
def profile_events(spark, sf_dir):
    """Per column: rows, NULLs, non-NULLs, distinct values - DESCRIBE re-aimed."""
    return profile_table(Tables(spark, sf_dir).events, _EVENT_COLS)


@report("profile_customer_gaps", ops=("S3", "D1", "D12"), sql=f"""
WITH c AS (SELECT c_custkey, {SEG_SQL} AS seg, c_acctbal FROM customer)
SELECT 'c_custkey' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(c_custkey) AS n_nulls,
       COUNT(c_custkey) AS n_non_null, COUNT(DISTINCT c_custkey) AS n_distinct FROM c
UNION ALL
SELECT 'seg', COUNT(*), COUNT(*) - COUNT(seg), COUNT(seg), COUNT(DISTINCT seg) FROM c
UNION ALL
SELECT 'c_acctbal', COUNT(*), COUNT(*) - COUNT(c_acctbal), COUNT(c_acctbal), COUNT(DISTINCT c_acctbal) FROM c
""")
def profile_customer_gaps(spark, sf_dir):
    """Profile of a table with NULLs and blanks: the blank counts as a value, NULL does not."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", segment_with_gaps().alias("seg"), "c_acctbal")
    return profile_table(c)


@report("duplicate_keys", ops=("D4", "A13"), sql="""
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def duplicate_keys_report(spark, sf_dir):
    """(order, line) keys that occur more than once: the table has no primary key."""
    return duplicate_keys(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


@report("orphan_keys", ops=("D6", "J9", "J11"), sql="""
WITH e AS (SELECT user_id AS key, COUNT(*) AS n_rows FROM events GROUP BY user_id),
     c AS (SELECT c_custkey AS key, COUNT(*) AS n_rows FROM customer GROUP BY c_custkey)
SELECT 'events' AS only_in, e.key, e.n_rows FROM e WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.key = e.key)
UNION ALL
SELECT 'customer' AS only_in, c.key, c.n_rows FROM c WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.key = c.key)
""")
def orphan_keys_report(spark, sf_dir):
    """Keys on one side of the events-customer relation only, both directions."""
    t = Tables(spark, sf_dir)
    return orphan_keys(t.events, t.customer, "user_id", "c_custkey", "events", "customer")


@report("blank_null_breakdown", ops=("D12", "X14", "A11"), sql=f"""
WITH s AS (SELECT {SEG_SQL} AS seg FROM customer)
SELECT 'nothing' AS kind, COUNT(*) AS n_rows FROM s WHERE seg IS NULL HAVING COUNT(*) > 0
UNION ALL SELECT 'blank', COUNT(*) FROM s WHERE seg = '' HAVING COUNT(*) > 0
UNION ALL SELECT 'value', COUNT(*) FROM s WHERE seg > '' HAVING COUNT(*) > 0
""")
def blank_null_breakdown_report(spark, sf_dir):
    """NULL vs empty string vs value counts of a label column."""
    c = Tables(spark, sf_dir).customer.select(segment_with_gaps().alias("seg"))
    return blank_null_breakdown(c, "seg")


@report("test_account_flag", ops=("D5", "J5", "A11"), sql="""
WITH per_cust AS (SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey)
SELECT CAST(c.c_acctbal < 0 AS INTEGER) AS is_test, COUNT(*) AS n_customers,
       CAST(COALESCE(SUM(p.n_orders), 0) AS BIGINT) AS n_orders
FROM customer c LEFT JOIN per_cust p ON c.c_custkey = p.o_custkey
GROUP BY 1
""")
def test_account_flag(spark, sf_dir):
    """Flag accounts by a marker convention - here an impossible (negative) balance - and
    size what they would contribute."""
    t = Tables(spark, sf_dir)
    per_cust = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    j = t.customer.select("c_custkey", "c_acctbal").join(per_cust, "c_custkey", "left")
    return j.groupBy((F.col("c_acctbal") < 0).cast("int").alias("is_test")).agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.coalesce(F.sum("n_orders"), F.lit(0)).cast("long").alias("n_orders"))


@report("impossible_values", ops=("D2", "D11", "F13"), sql="""
SELECT COUNT(*) FILTER (WHERE l_discount < 0 OR l_discount > 1) AS n_bad_discount,
       COUNT(*) FILTER (WHERE l_quantity <= 0) AS n_bad_quantity,
       COUNT(*) FILTER (WHERE l_extendedprice < 0) AS n_negative_price,
       COUNT(*) FILTER (WHERE l_tax < 0) AS n_negative_tax,
       COUNT(*) FILTER (WHERE l_shipdate IS NULL) AS n_missing_date
FROM lineitem
""")
def impossible_values(spark, sf_dir):
    """Counts of values no real transaction can have (the outlier hunts of the duration lessons)."""
    li = Tables(spark, sf_dir).lineitem
    d = F.col("l_discount")
    return li.agg(F.count_if((d < 0) | (d > 1)).alias("n_bad_discount"),
                  F.count_if(F.col("l_quantity") <= 0).alias("n_bad_quantity"),
                  F.count_if(F.col("l_extendedprice") < 0).alias("n_negative_price"),
                  F.count_if(F.col("l_tax") < 0).alias("n_negative_tax"),
                  F.count_if(F.col("l_shipdate").isNull()).alias("n_missing_date"))


@report("csv_roundtrip", ops=("S5", "F1"), sql=f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, {SEG_SQL} AS c_mktsegment FROM customer
""")
def csv_roundtrip(spark, sf_dir):
    """Export a complete result as CSV into the shared folder, then read it back with the
    table's schema: blank labels stay blank, NULL ones NULL.  Every task writes its own part file."""
    sel = Tables(spark, sf_dir).customer.withColumn("c_mktsegment", segment_with_gaps())
    path = write_csv(sel, export_folder(spark, "customer"))
    delete_at_exit(spark, path)
    return read_csv(spark, path, SCHEMAS["customer"])


@report("csv_roundtrip_texts", ops=("S5", "F7"), sql="""
SELECT doc_id, text, lang, source, n_chars FROM documents
""")
def csv_roundtrip_texts(spark, sf_dir):
    """The same for whole texts with line breaks, quotes and commas."""
    path = write_csv(Tables(spark, sf_dir).documents, export_folder(spark, "documents"))
    delete_at_exit(spark, path)
    return read_csv(spark, path, SCHEMAS["documents"])
