import datetime as dt

from pyspark.sql import functions as F

from quarry.operators.coverage import in_whole_months, incomplete_months, month_coverage
from quarry.plans import QUERIES
from quarry.sources import Tables


def days(spark, *spans):
    """Rows on every day of the spans, twice on some, and without a time."""
    out = [(None,)]
    for first, last in spans:
        at = dt.datetime.fromisoformat(first)
        while at <= dt.datetime.fromisoformat(last):
            out += [(at,)] * (1 + at.day % 2)
            at += dt.timedelta(days=1)
    return spark.createDataFrame(out, "ts timestamp_ntz")


def test_coverage_against_the_calendar(spark):
    df = days(spark, ("2024-02-01", "2024-02-29"), ("2024-03-17", "2024-04-14"), ("2024-06-01", "2024-06-15"))
    got = {r["month"].isoformat(): (r["n_days"], r["days_in_month"]) for r in month_coverage(df, "ts").collect()}
    assert got == {"2024-02-01": (29, 29), "2024-03-01": (15, 31), "2024-04-01": (14, 30), "2024-06-01": (15, 30)}
    assert incomplete_months(df, "ts") == [dt.date(2024, 3, 1), dt.date(2024, 4, 1)]  # June has exactly half
    assert incomplete_months(df, "ts", 0.6) == [dt.date(2024, m, 1) for m in (3, 4, 6)]
    kept = in_whole_months(df, df, "ts")
    assert {r[0] for r in kept.select(F.month("ts")).distinct().collect()} == {2, 6}
    assert in_whole_months(df, df, "ts", 0.0).count() == df.count() - 1
    assert incomplete_months(df.limit(0), "ts") == []


def test_another_last_month_is_found(spark, sf_small, tmp_path):
    t = Tables(spark, sf_small)
    cut = t.lineitem.where("l_shipdate < timestamp_ntz'2000-09-04 00:00:00'")
    cut.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert incomplete_months(cut, "l_shipdate") == [dt.date(2000, 9, 1)]
    plan = QUERIES["best_month_per_supplier"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "2000-09-01" in plan and "2001-11" not in plan
