"""Mixing sources to target weights by weighted fair queueing.

Every document is a packet in its source's queue.  The queue is in a fixed
pseudo-random order (a hash of seed, id and text); a packet's virtual finish
time is its source's words up to and with it, divided by the source's target.
A source may be queued ``max_repeat`` times over.  All packets, range-sorted by
finish time, form the mix, which is cut where the budget of words is spent.

Finish times rise along a queue, so what the mix takes of a source is a prefix
of its queue: whole rounds, then the packets up to one cut.  That cut, one row
per source, is all that the documents themselves need to be joined with.

Prefix sums are taken per (source, hash range): a source with a third of all
rows is split over every hash range.  The budget cut is found from totals per
range of virtual time; only the range that holds it is ordered packet by packet.
The only tables ordered whole have one row per source or per time range.

Defined results: a null source is a source of its own, after all others; null
or wordless text has size 0 and takes nothing; a source without words gets
target 0; repeated equal rows (id, text and source) are one packet, taken or
left together; packets that finish at the same tick are ordered by source, round,
place and id; an empty table gives no rows; columns other than id, text and
source are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD, forget, small, written

_UNIT_BITS = 40       # virtual time 1.0 is 2**40 ticks


def _packet(seed: int, id_col: str, text_col: str, source_col: str) -> list:
    """Columns of a packet: doc_id, source, size in words, place in the queue."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"), text)
    return [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            # 60 bits of a digest
            F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long").alias("place")]


def source_targets(packets: DataFrame, weights=(3, 1, 2), budget_share: float = 1.5,
                   max_repeat: int = 2) -> DataFrame:
    """One row per source: source, source_no, source_size, target (words).

    Sources in code-point order, null last, get the weights in turn.  The
    budget (``budget_share`` times all words) is shared by weight; a source
    stops at ``max_repeat`` times its size and the excess goes to the others.
    Sources are filled in order of cap per weight; ``level`` is what each unit
    of weight gets if all sources before are at their cap, and the first source
    that it does not lift to the cap fixes it for itself and all after.
    """
    per = packets.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("source_no", F.row_number().over(by_name))
    per = per.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.col("source_no") - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", (F.col("source_size") * max_repeat).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("level", (
        F.sum("source_size").over(whole) * F.lit(float(budget_share))
        - (F.sum("cap").over(upto) - F.col("cap"))) / F.sum("weight").over(onward))
    per = per.withColumn("fill", F.first(
        F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level")),
        ignorenulls=True).over(upto))
    return per.select("source", "source_no", "source_size", F.coalesce(
        F.least(F.col("cap"), F.col("fill") * F.col("weight")), F.col("cap")).alias("target"))


def _queue_ends(packets: DataFrame, targets: DataFrame, max_repeat: int) -> DataFrame:
    """Packets of every round with their integer virtual finish time ``tick``."""
    queued = (packets.join(small(targets), packets["source"].eqNullSafe(targets["source"]))
              .where("size > 0")
              .groupBy("source_no", "place", "doc_id", "source_size", "target")
              .agg(F.sum("size").alias("size"))
              .withColumn("span", F.shiftright("place", 52)))  # 256 ranges of the 60-bit places
    totals = queued.groupBy("source_no", "span").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_no").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source_no", "span", F.coalesce(
        F.sum("words").over(before), F.lit(0)).alias("words_before"))
    inside = Window.partitionBy("source_no", "span").orderBy("place", "doc_id")
    return (queued
            .withColumn("running", F.sum("size").over(
                inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .join(offsets, ["source_no", "span"])
            .withColumn("round", F.explode(F.array(*[F.lit(i) for i in range(max_repeat)])))
            .select("source_no", "round", "place", "doc_id", "size", F.floor(
                (F.col("words_before") + F.col("running") + F.col("round") * F.col("source_size"))
                / F.col("target") * float(2**_UNIT_BITS)).alias("tick")))


def _cut_tick(ends: DataFrame, budget: float) -> tuple[int, int, float] | None:
    """(first tick, last tick, words left) of the range of ticks where the budget
    runs out, found by two rounds of totals per range; None if it never does."""
    low, high, left = 0, 2**62, budget
    for shift in (_UNIT_BITS - 12, _UNIT_BITS - 24):
        span = F.least(F.shiftright(F.col("tick") - low, shift), F.lit(8191))
        totals = (ends.where(F.col("tick").between(low, high)).groupBy(span.alias("span"))
                  .agg(F.sum("size").alias("words")))
        running = F.sum("words").over(Window.orderBy("span").rowsBetween(
            Window.unboundedPreceding, Window.currentRow))
        hit = (totals.withColumn("running", running).where(F.col("running") > left)
               .orderBy("span").first())
        if hit is None:
            return None
        left -= hit["running"] - hit["words"]
        low += hit["span"] << shift
        if hit["span"] < 8191:
            high = low + (1 << shift) - 1
    return low, high, left


def mix_cuts(docs: DataFrame, weights=(3, 1, 2), budget_share: float = 1.5, max_repeat: int = 2,
             seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """One row per source: source, source_size, target, and the prefix of its
    queue that the mix takes: ``rounds`` whole rounds, then all packets up to
    (``cut_place``, ``cut_id``)."""
    packets = written(docs.select(*_packet(seed, id_col, text_col, source_col)), "mix-packets")
    cuts = _packet_cuts(packets, weights, budget_share, max_repeat)
    forget(packets)
    return cuts


def _packet_cuts(packets: DataFrame, weights=(3, 1, 2), budget_share: float = 1.5, max_repeat: int = 2) -> DataFrame:
    """``mix_cuts`` of a written table of packets."""
    targets = written(source_targets(packets, weights, budget_share, max_repeat), "mix-targets")
    budget = (targets.agg(F.sum("source_size")).first()[0] or 0) * budget_share
    ends = written(_queue_ends(packets, targets, max_repeat), "mix-ends")
    cut = _cut_tick(ends, budget)
    if cut is None:
        taken = ends
    else:
        low, high, left = cut
        order = Window.orderBy("tick", "source_no", "round", "place", "doc_id")
        edge = (ends.where(F.col("tick").between(low, high))
                .withColumn("running", F.sum("size").over(
                    order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                .where(F.col("running") <= left).drop("running"))
        taken = ends.where(F.col("tick") < low).unionByName(edge)
    last = taken.groupBy("source_no").agg(F.max(F.struct("round", "place", "doc_id")).alias("last"))
    cuts = written(targets.join(last, "source_no", "left").select(
        "source", "source_size", "target", F.coalesce("last.round", F.lit(0)).alias("rounds"),
        F.coalesce("last.place", F.lit(-1)).alias("cut_place"), F.col("last.doc_id").alias("cut_id")),
        "mix-cuts")
    for t in (targets, ends):
        forget(t)
    return cuts


def _decide(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds source_size, target and copies (times the mix takes the row)."""
    c = cuts.withColumnRenamed("source", "cut_source")
    least = -(2**63)
    upto = F.struct(F.col("place"), F.coalesce("doc_id", F.lit(least))) <= F.struct(
        F.col("cut_place"), F.coalesce("cut_id", F.lit(least)))
    return rows.join(small(c), F.col("source").eqNullSafe(F.col("cut_source"))).withColumn(
        "copies", F.when(F.col("size") == 0, 0).otherwise(F.col("rounds") + F.when(upto, 1).otherwise(0)))


def mix_report(docs: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", **options) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: every document.

    The texts are read once, for the packets."""
    packets = written(docs.select(*_packet(seed, id_col, text_col, source_col)), "mix-packets")
    return _decide(packets, _packet_cuts(packets, **options)).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the documents' own columns, a row for every copy taken.

    Texts are not shuffled: each row decides by its source's cut."""
    cuts = mix_cuts(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"),
                       *_packet(seed, id_col, text_col, source_col))
    return (_decide(rows, cuts).where("copies > 0")
            .select("own", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .select("own.*"))
