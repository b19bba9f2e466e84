"""Finding labels that are spellings of one (D8): "Beagle Mix" and "Beagle- Mix".

Two labels are linked if their fingerprints agree (letters folded, marks dropped,
words sorted), or if their folded forms differ by one edit: a character changed,
added or dropped.  Links run over shared keys, never over pairs of labels:

* a fingerprint is a key;
* a label with the character at place ``i`` left out, together with ``i``, is a
  key of all labels that differ from it at that place alone;
* a label with one character left out, wherever, meets the label it then is.

So a label has as many keys as characters, no two labels are compared, and a key
that very many labels share is one minimum, found by partial aggregation.
Clusters are the connected labels; each is named by its most frequent label.

Labels are reduced to distinct ones with counts before anything else.  NULL and
labels without a letter or digit belong to no cluster and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import kept


def folded(label: Column) -> Column:
    """Lower case, white space as single spaces."""
    return F.trim(F.regexp_replace(F.lower(label), r"\s+", " "))


def fingerprint(label: Column) -> Column:
    """The label's distinct words in order, without marks and case."""
    words = F.split(F.regexp_replace(F.lower(label), r"[^\p{L}\p{N}]+", " "), " ")
    return F.array_join(F.array_sort(F.array_distinct(F.filter(words, lambda w: w != ""))), " ")


def _hashes(text: Column, place: Column) -> list[Column]:
    """A key as two 64-bit hashes: keys as long as the label times its length would weigh more than the table."""
    return [F.xxhash64(text, place).alias("h1"), F.xxhash64(F.lit(17), text, place).alias("h2")]


def _memberships(labels: DataFrame, least_length: int) -> DataFrame:
    """label, h1, h2: the keys of every label; labels with a key in common are linked."""
    whole = labels.select("label", *_hashes(F.col("mark"), F.lit(-1)))
    if least_length <= 0:
        return whole
    long = labels.where(F.length("text") >= least_length)
    places = long.select("label", "text", F.explode(F.sequence(F.lit(1), F.length("text"))).alias("at"))
    without = F.concat(F.expr("substring(text, 1, at - 1)"), F.expr("substring(text, at + 1)"))
    left_out = places.select("label", "at", without.alias("text"))
    changed = left_out.select("label", *_hashes(F.col("text"), F.col("at")))
    # What is left of one label may be another, whole: both have the key of that text.
    itself = long.select("label", *_hashes(F.col("text"), F.lit(0)))
    shorter = left_out.where(F.length("text") >= least_length).select(
        "label", *_hashes(F.col("text"), F.lit(0))).distinct()
    known = itself.select("h1", "h2").distinct()
    return whole.unionByName(changed).unionByName(itself).unionByName(
        shorter.join(known, ["h1", "h2"], "left_semi"))


def clusters(df: DataFrame, column: str, least_length: int = 5) -> DataFrame:
    """label, n_rows, cluster, cluster_labels, cluster_rows of every distinct label.

    The one-edit rule holds for labels of ``least_length`` characters or more (0:
    for none): of short words, most are one edit from another."""
    label = F.col(column).alias("label")
    counts = df.select(label).where(F.col("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
    labels = kept(counts.select("*", folded(F.col("label")).alias("text"), fingerprint(F.col("label")).alias("mark"))
                   .where("mark <> ''"), "label-texts")
    keys = _memberships(labels, least_length)
    # Keys of one label link nothing.
    shared = keys.groupBy("h1", "h2").agg(F.min("label").alias("first"), F.max("label").alias("last")).where(
        "first <> last").select("h1", "h2")
    member = kept(keys.join(shared, ["h1", "h2"], "left_semi"), "label-keys")
    # Each label takes the least label that a key of its own knows, until none changes.
    state = kept(member.select("label").distinct().withColumn("root", F.col("label")), "label-roots")
    while True:
        least = member.join(state, "label").groupBy("h1", "h2").agg(F.min("root").alias("least"))
        near = member.join(least, ["h1", "h2"]).groupBy("label").agg(F.min("least").alias("near"))
        # A root's own root is as good, and halves the way.
        jump = state.select(F.col("label").alias("near"), F.col("root").alias("far"))
        moved = kept(near.join(jump, "near").select("label", F.least("near", "far").alias("root")), "label-roots")
        changed = moved.join(state.withColumnRenamed("root", "old"), "label").where("root <> old").limit(1).count()
        state = moved
        if not changed:
            break
    rooted = labels.join(state, "label", "left").select("label", "n_rows", F.coalesce("root", "label").alias("root"))
    named = rooted.groupBy("root").agg(
        F.min(F.struct(F.negate("n_rows").alias("n"), F.col("label"))).alias("name"),
        F.count(F.lit(1)).alias("cluster_labels"), F.sum("n_rows").alias("cluster_rows"))
    return rooted.join(named, "root").select("label", "n_rows", F.col("name.label").alias("cluster"),
                                             "cluster_labels", "cluster_rows")
