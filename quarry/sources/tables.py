"""Table loading with explicit schemas.

Every table is read through ``spark.read.schema(...).parquet(...)`` so the
types are fixed at the boundary (no inference pass over the files) and the
Parquet scan keeps column pruning and filter pushdown: a report that reads
two columns scans two columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.layouts import bucketed, by_month_is_current
from quarry.sources.sinks import month_partitions

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_TS = T.TimestampNTZType()


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I),
                        ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
    "documents": _schema(("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S),
                         ("n_chars", _L)),
    "labels": _schema(("doc_id", _L), ("quality", _I), ("toxic", _I)),
    "pages": _schema(("page_id", _L), ("url", _S), ("html", _S)),
    "benchmark": _schema(("item_id", _L), ("text", _S)),
    "conversations": _schema(("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S)),
    "embeddings": _schema(("vec_id", _L), ("embedding", T.ArrayType(T.FloatType())),
                          ("label", _I)),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table by name from a directory of ``<name>.parquet`` files."""
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(sf_dir, name))


class Tables:
    """Lazy attribute access to the tables of one directory: ``t.lineitem``.

    Each access builds a fresh DataFrame (cheap: no job runs), so two uses of
    one table in a plan are two independent scans that Catalyst can prune and
    filter separately, and that Spark may reuse through exchange reuse.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in SCHEMAS:
            return load(self.spark, self.sf_dir, name)
        raise AttributeError(name)


    def in_months(self, name: str, ts_col: str, months) -> DataFrame:
        """A fact's rows of some calendar months, of any year.

        Where the folder has a copy laid out by month (``<name>_by_month``, see
        ``layouts.publish_by_month``) that was made from the fact as it is now,
        the months select its folders, and Spark opens no other; else the whole
        fact is read and filtered."""
        path = f"{self.sf_dir.rstrip('/')}/{name}_by_month"
        if by_month_is_current(self.spark, table_path(self.sf_dir, name), path):
            schema = T.StructType([*SCHEMAS[name].fields, T.StructField("part_year", _I), T.StructField("part_month", _I)])
            rows = self.spark.read.schema(schema).parquet(path).filter(month_partitions(months=months))
            return rows.select(*SCHEMAS[name].fieldNames())
        return getattr(self, name).filter(F.month(ts_col).isin(list(months)))

    def by_key(self, name: str, key: str) -> DataFrame:
        """A table for a join on ``key``: its bucketed copy where there is a
        current one (see ``layouts.publish_bucketed``), else the table itself."""
        copy = bucketed(self.spark, table_path(self.sf_dir, name), key)
        return getattr(self, name) if copy is None else copy


def register_views(spark: SparkSession, sf_dir: str, names=None, qualified: bool = False) -> list[str]:
    """Register the tables as views so ``spark.sql`` can name them.

    By default they are session views (``FROM orders``).  With
    ``qualified=True`` they are registered in Spark's ``global_temp`` database
    instead, the ``db.table`` form (``FROM global_temp.orders``) - the same
    choose-a-database-then-qualify pattern, without a metastore.
    """
    out = []
    for name in names or SCHEMAS:
        df = load(spark, sf_dir, name)
        if qualified:
            df.createOrReplaceGlobalTempView(name)
            out.append(f"global_temp.{name}")
        else:
            df.createOrReplaceTempView(name)
            out.append(name)
    return out
