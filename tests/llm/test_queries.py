import importlib
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from quarry.llm.queries import ORACLE, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def plain(rows, columns):
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    return order, sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in (r[i] for i in at)) for r in rows),
                         key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    want = plain(cur.fetchall(), [c[0] for c in cur.description])
    df = QUERIES[name](spark, sf_small)
    assert plain([tuple(r) for r in df.collect()], df.columns) == want


def test_ten_queries_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert "pipeline" in names


def test_entry_works_without_the_subpackage(monkeypatch):
    for gone in ("corpus_pipeline", "quarry.llm", "quarry.llm.queries"):
        monkeypatch.setitem(sys.modules, gone, None)
    names = importlib.reload(entry).queries()
    assert names and not any(n.startswith("op1_") for n in names) and "pipeline" not in names
    assert "pipeline" not in entry.oracle_sql()
