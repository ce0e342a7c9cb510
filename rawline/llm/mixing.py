"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, passed over up to
``max_passes`` times. A copy's virtual finish time is the source's cumulative
words up to and including it, divided by the source's target. The copies of
all sources, in order of finish time, are cut at the total budget: every
source then has about its target.

Nothing gathers a source in one task: the shuffle key is split into slots, the
words of each (source, slot) are summed, running totals over the slots give
each slot's start, and only a slot's rows are ordered together. The global
order is dealt into ranges of finish time in the same way; only the range that
holds the cut is ordered copy by copy.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, n_words, settle

#: Weights by rank of the source's name, repeating.
WEIGHTS = (3, 1, 2)
#: Rows of a slot, about; the number of slots and ranges follows the input.
SLOT_ROWS = 8192
KEY_BITS = 60


def shuffle_key(doc_id: Column) -> Column:
    """A pseudo-random 60-bit place of a document in its source's queue."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_passes: int) -> DataFrame:
    """(source, source_size) -> also rank, target.

    Targets are shares of ``share`` times all words by weight, none above
    ``max_passes`` times its source; the excess goes to the others by weight.
    With sources by cap/weight, the level each would get if all before it are
    capped is a running expression; the first level within its own cap holds.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = (
        sizes.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_passes)
        .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after))
    )
    held = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(everything)
    return (
        ranked.withColumn("held", held["level"])
        .withColumn("target", F.when(F.col("held").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("held"))))
        .select("source", "source_size", "rank", "target", "budget")
    )


#: What the mix tells of a row.
RESULTS = ("size", "source_size", "target", "taken", "finish")


def mix_sources(
    docs: DataFrame,
    columns: list[str],
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    max_passes: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: its ``columns``, size, source_size, target,
    taken (words the mix takes, repeats counted), finish (array: the finish
    times of the copies that the mix takes, in order).

    ``docs`` needs doc_id, text and source. A null text has no words; words of
    a null source count as a source of their own, named last. Documents
    without words are never taken (taken 0, no finish times). Rows that repeat
    a doc_id are separate documents, ordered by size within their tie; fully
    equal rows are interchangeable. An empty table gives an empty result.
    Other columns are carried unread and may have any name: a result whose name
    one of ``columns`` has gets underscores in front (``free_names``).
    """
    decided = _decided(docs, columns, weights, share, max_passes)
    own = dict(zip(RESULTS, free_names(list(RESULTS), columns)))
    return decided.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(columns)], *[F.col(r).alias(own[r]) for r in RESULTS])


def _decided(docs: DataFrame, columns: list[str], weights: tuple[int, ...], share: float, max_passes: int) -> DataFrame:
    """``row`` (``columns`` as c0, c1, ...) with the RESULTS of the mix."""
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]).alias("row"),
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
        shuffle_key(F.col("doc_id")).alias("key"),
    )
    sized = settle(sized, "mix-sized")
    rows = sized.count()
    bits = max(0, math.ceil(math.log2(max(1, rows) / SLOT_ROWS)))
    slot = F.shiftright("key", KEY_BITS - bits)

    slots = sized.groupBy("source", slot.alias("slot")).agg(F.sum("size").alias("words"))
    slots = settle(slots, "mix-slots")
    targets = settle(source_targets(slots.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, max_passes), "mix-targets")
    earlier = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slots.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    t = targets.withColumnRenamed("source", "of")
    starts = starts.join(t, starts["source"].eqNullSafe(t["of"])).select(F.col("source").alias("of"), F.col("slot").alias("at"), "start", "source_size", "rank", "target")

    queue = Window.partitionBy("rank", "slot").orderBy("key", "doc_id", "size")
    served = F.sum("size").over(queue.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = sized.withColumn("slot", slot)
    placed = placed.join(starts, placed["source"].eqNullSafe(starts["of"]) & (placed["slot"] == starts["at"]))
    finish = [
        F.when((F.col("size") > 0) & (F.col("target") > 0), (F.col("served") + F.lit(p) * F.col("source_size")) / F.col("target"))
        for p in range(max_passes)
    ]
    timed = placed.withColumn("served", F.col("start") + served).select("row", "size", "source_size", "rank", "target", F.array(*finish).alias("times"))
    timed = settle(timed, "mix-timed")

    copies = timed.select("size", "rank", F.explode("times").alias("time")).filter(F.col("time").isNotNull())
    ranges = max(1024, 2**bits)
    span = F.least(F.floor(F.col("time") * ranges), F.lit(8 * ranges)).cast("long")
    budget = F.lit((targets.agg(F.max("budget")).first() or [None])[0] or 0.0)
    by_range = copies.groupBy(span.alias("span")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.orderBy("span").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    crossing = by_range.withColumn("upto", upto).filter(F.col("upto") > budget).agg(F.min(F.struct("span", F.col("upto") - F.col("words"))).alias("x")).first()
    cut = None
    if crossing["x"] is not None:
        at, spent = crossing["x"][0], crossing["x"][1]
        order = Window.orderBy("time", "rank")
        running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.lit(spent)
        inside = copies.filter(span == at).withColumn("running", running).filter(F.col("running") <= budget)
        last = inside.agg(F.max(F.struct("time", "rank")).alias("x")).first()["x"]
        # with no copy inside, all of the ranges before are taken and none of this one
        cut = (last["time"], last["rank"]) if last is not None else (math.nextafter(at / ranges, 0.0), 0)

    def admitted(time: Column) -> Column:
        if cut is None:
            return time.isNotNull()
        return (time < F.lit(cut[0])) | ((time == F.lit(cut[0])) & (F.col("rank") <= F.lit(cut[1])))

    decided = timed.withColumn("finish", F.filter("times", admitted))
    return decided.select(
        "row", "size", "source_size", "target", (F.col("size") * F.size("finish")).cast("long").alias("taken"), "finish"
    )


def mixed_documents(
    docs: DataFrame, columns: list[str], weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, max_passes: int = 2
) -> DataFrame:
    """The mix itself: one row per copy taken, with ``columns``, its pass and
    virtual finish time (named as in :func:`mix_sources` if ``columns`` hold
    such names), range-sorted by finish time."""
    decided = _decided(docs, columns, weights, share, max_passes)
    copies = decided.select("row", F.posexplode("finish").alias("pass", "finish")).orderBy("finish")
    own = free_names(["pass", "finish"], columns)
    return copies.select(
        *[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(columns)], F.col("pass").alias(own[0]), F.col("finish").alias(own[1])
    )
