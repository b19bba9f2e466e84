"""Every report against its oracle on a copy of the tables with repeated dimension rows,
NULL keys, NULL dates and NULL flags, which the driver's tables lack."""

import duckdb
import pytest

from quarry.plans import ORACLE, QUERIES
from tools.check_oracle import TABLES, canon

CHANGES = {
    "customer": """SELECT * FROM t UNION ALL SELECT * FROM t WHERE c_custkey % 3 = 1
                   UNION ALL SELECT * REPLACE (NULL AS c_custkey) FROM t WHERE c_custkey < 3""",
    "part": "SELECT * FROM t UNION ALL SELECT * FROM t WHERE p_partkey % 3 = 1",
    "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE o_orderdate END AS o_orderdate,
                                   CASE WHEN o_orderkey % 40 = 3 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
                                   CASE WHEN o_orderkey % 70 = 5 THEN NULL ELSE o_custkey END AS o_custkey) FROM t""",
    "lineitem": """SELECT * REPLACE (CASE WHEN l_suppkey = 3 OR l_orderkey % 60 = 9 THEN NULL ELSE l_shipdate END AS l_shipdate,
                                     CASE WHEN l_orderkey % 90 = 4 THEN NULL ELSE l_partkey END AS l_partkey) FROM t""",
    "events": """SELECT * REPLACE (CASE WHEN event_id % 30 = 2 THEN NULL ELSE event_type END AS event_type,
                                   CASE WHEN event_id % 20 = 2 THEN NULL ELSE ts END AS ts) FROM t""",
}


@pytest.fixture(scope="module")
def dirty(tmp_path_factory, sf_small):
    out = str(tmp_path_factory.mktemp("dirty"))
    con = duckdb.connect()
    for t in TABLES:
        sql = f"WITH t AS (SELECT * FROM read_parquet('{sf_small}/{t}.parquet')) {CHANGES.get(t, 'SELECT * FROM t')}"
        con.execute(f"COPY ({sql}) TO '{out}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{out}/{t}.parquet')")
    return out, con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_report_on_dirty_tables(spark, dirty, name):
    out, con = dirty
    df = QUERIES[name](spark, out)
    cur = con.execute(ORACLE[name])
    want_cols, want = canon([c[0] for c in cur.description], cur.fetchall())
    cols, got = canon(df.columns, [tuple(r) for r in df.collect()])
    assert cols == want_cols
    assert got == want
