"""Secret scans through an incremental blob ledger.

Every version of every document is a blob, addressed by the SHA-256 of its
UTF-8 text.  The ledger is a folder with two tables: ``scanned`` (blob, rules:
the pairs done) and ``findings`` (blob, rules, kind, start, end).  A scan takes
only pairs of blob and rule version that the ledger lacks, each once however
many paths hold the blob, appends what it found, and joins the findings back to
all paths.

Texts are reduced to one copy a blob before they are scanned, so a blob that a
third of all rows hold is one scan, and its copies meet only narrow rows.

Defined results: a null text is the empty text (no finding); text of any length
is scanned whole; spans that start together are ordered by kind as listed;
repeated rows each get the findings; null ids are kept; an
empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import forget, scratch, small, text_or_empty, written

#: Version of the rules below; raise it with every change of a rule.
RULES_VERSION = "base-1"

KINDS = ("assign", "access", "hex")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 characters or more
_HEX = re.compile(r"[0-9a-f]{24,}")

_FOUND = "blob string, kind string, start long, end long"


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows: list[tuple] = []
        for blob, text in zip(batch["blob"], batch["text"], strict=True):
            rows += [(blob, *span) for span in find_spans(text)]
            rows.append((blob, None, None, None))  # scanned
        yield pd.DataFrame(rows, columns=["blob", "kind", "start", "end"]).astype({"start": "Int64", "end": "Int64"})


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class Ledger:
    """The two tables of a ledger folder, created empty on first use."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        at = f"{self.path}/{name}"
        if not _exists(self.spark, at):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(at)

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, rules string")

    def findings(self) -> DataFrame:
        return self._read("findings", "blob string, rules string, kind string, start long, end long")

    def unseen(self, texts: DataFrame, rules: str = RULES_VERSION) -> DataFrame:
        """blob, text: one row for each blob of ``texts`` that lacks this rule version.

        Copies are reduced to one by partial aggregation before they move, so
        neither repeated rows nor a text that a third of all rows hold bring
        more than one copy a task together.  Where few blobs are new, the texts
        of all others stay where they are."""
        blobs = texts.select("blob")
        done = self.scanned()
        if not done.isEmpty():
            new = written(blobs.distinct().join(done.where(F.col("rules") == rules).select("blob"), "blob", "left_anti"),
                          "ledger-unseen")
            texts = texts.join(small(new), "blob", "left_semi")
        return texts.groupBy("blob").agg(F.first("text").alias("text"))

    def update(self, texts: DataFrame, rules: str = RULES_VERSION) -> None:
        """Scan the blobs of ``texts`` (blob, text) that lack this rule version.

        Findings are appended before the pairs are marked as scanned: a run that
        dies between the two scans those blobs again, and ``spans_by_blob``
        counts a span found twice once."""
        found = self.unseen(texts, rules).mapInPandas(_scan, _FOUND)
        kept = written(found, "ledger-found")
        kept.where("kind IS NOT NULL").select("blob", F.lit(rules).alias("rules"), "kind", "start", "end") \
            .write.mode("append").parquet(f"{self.path}/findings")
        kept.where("kind IS NULL").select("blob", F.lit(rules).alias("rules")) \
            .write.mode("append").parquet(f"{self.path}/scanned")
        forget(kept)

    def spans_by_blob(self, rules: str = RULES_VERSION) -> DataFrame:
        """blob, spans (array of start, order, kind, end; sorted): blobs with findings."""
        order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
        return (self.findings().where(F.col("rules") == rules).groupBy("blob").agg(F.sort_array(
            F.collect_set(F.struct("start", order.alias("order"), "kind", "end"))).alias("spans")))


def _with_blob(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.sha2(text.cast("binary"), 256).alias("blob"))


def scan(docs: DataFrame, ledger_path: str | None = None, rules: str = RULES_VERSION,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, blob, spans (null without findings): every path with its findings.

    ``ledger_path`` keeps the ledger over runs; without it a new, empty ledger
    under the shared folder serves this run."""
    spark = docs.sparkSession
    ledger = Ledger(spark, ledger_path or scratch(spark, "ledger"))
    texts = _with_blob(docs, id_col, text_col)
    ledger.update(texts, rules)
    # Written: the join is one of two plain exchanges, whose hot blobs Spark can split.
    found = written(ledger.spans_by_blob(rules), "ledger-spans")
    return texts.select("doc_id", "blob").join(small(found, "spans"), "blob", "left")


def redacted(docs: DataFrame, marker: str = "[secret]", ledger_path: str | None = None,
             rules: str = RULES_VERSION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every found span replaced by ``marker``; all rows and
    columns stay, ``n_chars``, where present, follows the new text."""
    spark = docs.sparkSession
    ledger = Ledger(spark, ledger_path or scratch(spark, "ledger"))
    texts = _with_blob(docs, id_col, text_col)
    ledger.update(texts, rules)
    found = written(ledger.spans_by_blob(rules), "ledger-spans")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"),
                       F.col(text_col).alias("text"),
                       F.sha2(text_or_empty(text_col).cast("binary"), 256).alias("blob"))
    rows = rows.join(small(found, "spans"), "blob", "left")
    clean = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.expr(f"""
        aggregate(spans, named_struct('at', 0L, 'out', ''),
            (acc, s) -> if(s.end <= acc.at, acc, named_struct('at', s.end, 'out', concat(acc.out,
                substring(text, cast(acc.at as int) + 1, cast(greatest(s.start - acc.at, 0) as int)), '{marker}'))),
            acc -> concat(acc.out, substring(text, cast(acc.at as int) + 1)))"""))
    rows = rows.withColumn("clean", clean)
    own = {c: F.col(f"own.`{c}`") for c in docs.columns}
    own[text_col] = F.col("clean")
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("spans").isNull(), own["n_chars"]).otherwise(
            F.char_length("clean").cast(docs.schema["n_chars"].dataType))
    return rows.select(*[v.alias(k) for k, v in own.items()])
