"""Sources and sinks: explicit schemas, views, CSV round trip, month partitions."""

import pytest

from quarry.functions import in_period
from quarry.sources import (SCHEMAS, Tables, export_folder, month_partitions, read_csv,
                            register_views, write_by_month, write_csv)


def test_tables_use_declared_schemas(spark, sf_small):
    t = Tables(spark, sf_small)
    for name in ("lineitem", "orders", "events", "customer"):
        assert getattr(t, name).schema == SCHEMAS[name]


def test_views_answer_sql(spark, sf_small):
    register_views(spark, sf_small, ["region", "nation"])
    n = spark.sql("SELECT COUNT(*) FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey").first()[0]
    assert n == Tables(spark, sf_small).nation.count()


def test_qualified_views(spark, sf_small):
    assert register_views(spark, sf_small, ["region"], qualified=True) == ["global_temp.region"]
    assert spark.sql("SELECT COUNT(*) FROM global_temp.region").first()[0] == 5


@pytest.mark.parametrize("name", ["customer", "documents", "conversations", "pages"])
def test_csv_export_is_complete(spark, sf_small, name):
    df = getattr(Tables(spark, sf_small), name)
    back = read_csv(spark, write_csv(df, export_folder(spark, "test-csv")), SCHEMAS[name])
    assert back.count() == df.count()
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_csv_keeps_blank_and_null_apart(spark):
    rows = [(1, None), (2, ""), (3, " a "), (4, 'x"y, z'), (5, "two\nlines"), (6, "\\N"), (7, "\\")]
    df = spark.createDataFrame(rows, "i int, s string")
    back = read_csv(spark, write_csv(df, export_folder(spark, "test-csv"), max_records=2), df.schema)
    got = {r["i"]: r["s"] for r in back.collect()}
    assert {i: got[i] for i in range(1, 6)} == dict(rows[:5]) and got[7] == "\\"


def test_month_partitions_prune(spark, sf_small):
    li = Tables(spark, sf_small).lineitem
    path = write_by_month(li, export_folder(spark, "test-by-month"), "l_shipdate")
    part = spark.read.parquet(path)
    sel = part.filter(month_partitions(1998, [8]) & in_period("l_shipdate", 1998, 8))
    plan = sel._sc._jvm.PythonSQLUtils.explainString(sel._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(part_year" in plan
    assert sel.count() == li.filter(in_period("l_shipdate", 1998, 8)).count()
    assert part.filter(month_partitions(1998, [8], exclude=True)).count() == \
        li.count() - li.filter(in_period("l_shipdate", 1998, 8)).count()


def test_jdbc_reader_needs_bounds_for_partitioned_reads(spark):
    from quarry.sources.jdbc import read_table
    with pytest.raises(ValueError):
        read_table(spark, "jdbc:none://nowhere", "t", partition_column="id")
