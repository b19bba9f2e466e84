"""Reports that promise an order, compared row by row in that order."""

import re

import duckdb
import pytest

from quarry.plans import ORACLE, QUERIES
from tools.check_oracle import TABLES, norm


def outer(sql: str) -> str:
    """The statement without what stands in parentheses."""
    while (short := re.sub(r"\([^()]*\)", "", sql)) != sql:
        sql = short
    return sql


ORDERED = sorted(n for n, sql in ORACLE.items() if "ORDER BY" in outer(sql))


def test_some_reports_are_ordered():
    assert len(ORDERED) >= 15


@pytest.mark.parametrize("name", ORDERED)
def test_rows_come_in_order(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    columns = [c[0] for c in cur.description]
    want = [tuple(norm(v) for v in r) for r in cur.fetchall()]
    df = QUERIES[name](spark, sf_small).select(*columns)
    assert [tuple(norm(v) for v in r) for r in df.collect()] == want
