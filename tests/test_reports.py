"""Every registered report against its SQL oracle (DuckDB) on the smallest tables,
plus the driver-contract smoke checks."""

import duckdb
import pytest

import __spark_entry__ as entry
from quarry.plans import ORACLE, QUERIES
from tools.check_oracle import TABLES, canon, type_mismatches



@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["best_month", "month_num", "n_suppliers"]
    assert df.count() >= 0


def test_every_report_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_report_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    s_rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    d_rows = rel.fetchall()
    sc, sr = canon(df.columns, s_rows)
    dc, dr = canon(rel.columns, d_rows)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
    assert type_mismatches(df.schema, dict(zip(rel.columns, [str(t) for t in rel.types]))) == []
