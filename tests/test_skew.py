"""Reports on a derived copy of the tables in which one key holds a third of the rows,
checked against their SQL oracle (the hot-key cases the driver data lacks)."""

import duckdb
import pytest

from quarry.plans import ORACLE, QUERIES
from quarry.sources import export_folder
from tools.check_oracle import TABLES, canon
from tools.skew_drill import derive

REPORTS = ["best_month_per_supplier", "returns_month_per_supplier", "rise_nov_dec_dept",
           "duration_minutes_stats", "rows_above_average_duration", "join_inner_two_keys",
           "join_fanout", "join_left_counts", "users_per_segment", "top_nations_by_active_customers",
           "orphan_keys", "spread_by_group", "attr_and_representative", "dedupe_before_join",
           "brand_unlisted_parts", "profile_events", "weekday_counts", "clean_join_counts",
           "events_orders_exploded", "exact_price_quantiles", "distinct_by_month_and_total",
           "lines_of_large_urgent_orders", "nation_month_spine", "lines_page_500"]


@pytest.fixture(scope="module")
def skewed(spark, sf_small):
    out = export_folder(spark, "skewed-tables")
    derive(spark, sf_small, out)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{out}/{t}.parquet/*.parquet')")
    return out, con


@pytest.mark.parametrize("name", REPORTS)
def test_report_on_skewed_tables(spark, skewed, name):
    out, con = skewed
    df = QUERIES[name](spark, out)
    rel = con.sql(ORACLE[name])
    sc, sr = canon(df.columns, [tuple(r) for r in df.collect()])
    dc, dr = canon(rel.columns, rel.fetchall())
    assert sc == dc and sr == dr
