"""The corpus pipeline: raw documents to packed training sequences.

Five stages, each a Spark job over all that the one before kept, written as
Parquet to the shared folder and read again:

1. toxicity      documents scoring 0.5 or more go
2. near_dedup    one document of each near-duplicate component stays
3. secrets       found secrets are masked; all rows stay
4. mix           sources are mixed to their target weights: rows are repeated
                 or left out
5. pack          the mix's tokens in as few sequences of 1024 as found

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import hyperminhash, mixing, packing, secret_ledger, toxicity
from quarry.llm.common import table, written
from quarry.llm.queries import vocabulary_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels, scores under 0.5."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each component."""
    return hyperminhash.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a marker and n_chars brought up to date."""
    return secret_ledger.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time the mix takes a document: 150 % of all words, weights
    3, 1, 2 over the sources in turn, no document more than twice."""
    return mixing.mixed(docs, weights=(3, 1, 2), budget_share=1.5, max_repeat=2)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every row in sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary_path(), capacity=1024, end_id=2)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("secrets", mask_secrets),
          ("mix", mix_sources), ("pack", pack_sequences)]

#: The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
