"""Benchmark decontamination by SimHash of item-sized windows.

A document is read through windows as long as a benchmark item. A window's
fingerprint (64 bits, each shingle voting once per occurrence) is looked up in
a multi-index: the fingerprint is cut into blocks, every item is stored under
all values near each of its blocks, so that every fingerprint within the
radius meets in some block. What meets is verified by the whole Hamming
distance and then by the exact weighted similarity of the shingles (sum of the
smaller counts over the sum of the larger).

A window gets a fingerprint if as many of its shingles stand in items of its
length as the similarity needs at least, wherever they stand in the item; any
other window is less similar to every item, in whatever order its parts stand.
All of it is DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, same_id, settle

SHINGLE = 5
SIMILARITY = 0.8
#: Blocks of the fingerprint, and bits by which an item's block is varied:
#: together they guarantee all fingerprints within BLOCKS * (VARY + 1) - 1 bits.
BLOCKS, VARY = 6, 2
RADIUS = BLOCKS * (VARY + 1) - 1


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits of a text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingles(words: Column, size: int, first: Column, n: Column) -> Column:
    """``n`` shingle hashes of ``size`` words from position ``first`` on (from 0)."""
    one = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)])
    return F.when(n > 0, F.transform(F.sequence(first, first + n - 1), one)).otherwise(F.array().cast("array<bigint>"))


def promising_starts(at: Column, n: Column, need: Column, last: Column) -> Column:
    """Starts (at most ``last``) of the windows of ``n`` shingles of which
    ``need`` stand at the ascending positions ``at``. From the i-th of them
    on, ``need`` are within reach of the starts between two bounds; a start
    before the (i-1)-th is given out there."""
    low = lambda i: F.greatest(F.lit(0), F.get(at, i + need - 1) - n + 1, F.coalesce(F.get(at, i - 1) + 1, F.lit(0)))
    bounds = F.transform(F.sequence(F.lit(0), F.size(at) - need), lambda i: F.struct(low(i).alias("low"), F.least(F.get(at, i), last).alias("high")))
    some = F.transform(F.filter(bounds, lambda b: b["low"] <= b["high"]), lambda b: F.sequence(b["low"], b["high"]))
    return F.when(F.size(at) >= need, F.flatten(some)).otherwise(F.array().cast("array<int>"))


def fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fp): SimHash over each key's exploded shingles (sh, weight n)."""
    bits = [F.sum(F.shiftright("sh", b).bitwiseAND(F.lit(1)) * F.col("n")).alias(f"b{b}") for b in range(64)]
    votes = rows.groupBy(*keys).agg(*bits, F.sum("n").alias("total"))
    fp = reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.col(f"b{b}") * 2 > F.col("total"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0)) for b in range(64)])
    return votes.select(*keys, fp.alias("fp"), "total")


def block_values(fp: Column, vary: int) -> Column:
    """array<struct<block, value>>: each block with every mask of at most
    ``vary`` of its bits."""
    out, at = [], 0

    def varied(block: int, value: Column, masks: list[int]) -> Column:
        row = lambda m: F.struct(F.lit(block).alias("block"), value.bitwiseXOR(m).alias("value"))
        return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), row)

    for k in range(BLOCKS):
        size = 64 // BLOCKS + (1 if k < 64 % BLOCKS else 0)
        value = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << size) - 1))
        out.append(varied(k, value, [m for m in range(1 << size) if m.bit_count() <= vary]))
        at += size
    return F.flatten(F.array(*out))


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(rid, doc_id, item_id, similarity, start_word, n_words, bits): for each
    document and item the most similar window of at least ``similarity``, rid
    being ``row_key`` of the document's row. Of equally similar windows the
    earliest counts.

    ``docs`` needs doc_id and text, ``items`` item_id and text. Null, empty or
    wordless texts on either side match nothing; items with equal words are one
    item, with the smallest item_id. An item of under 5 words is one shingle
    of all its words; a document shorter than an item is one window. Rows that
    repeat doc_id and text are reported once. Empty tables give an empty
    result. Other columns are not read.
    """
    w = items.select(F.col("item_id").cast("long").alias("item_id"), word_hashes(F.col("text")).alias("w")).filter(F.size("w") > 0)
    w = w.groupBy("w").agg(F.min("item_id").alias("item_id")).withColumn("len", F.size("w")).withColumn("k", F.least(F.col("len"), F.lit(SHINGLE)))
    w = settle(w, "decontam-items")
    sizes = sorted(r["k"] for r in w.select("k").distinct().collect())  # at most SHINGLE rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("rid", row_key(F.col("doc_id"), F.col("text")))
    hashed = texts.select("rid", "doc_id", word_hashes(F.col("text")).alias("w"))

    at_item, hits = [], []
    for k in sizes:
        own = w.filter(F.col("k") == k).select("item_id", "len", "k", F.explode(shingles(F.col("w"), k, F.lit(0), F.col("len") - k + 1)).alias("sh"))
        at_item.append(own)
        n = F.size("w") - k + 1
        found = hashed.select("rid", "doc_id", F.size("w").alias("words"), F.posexplode(shingles(F.col("w"), k, F.lit(0), n)).alias("p", "sh"))
        spots = own.select("sh", "len", "k").distinct()
        # all positions of shingles of items of one length
        met = found.join(spots, "sh").groupBy("rid", "doc_id", "words", "len", "k").agg(F.sort_array(F.collect_set("p")).alias("at"))
        of_item, n = F.col("len") - k + 1, F.least(F.col("len"), F.col("words")) - k + 1
        # both / (n + of_item - both) >= similarity
        need = F.greatest(F.lit(1), F.ceil((n + of_item) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9)).cast("int"))
        starts = promising_starts(F.col("at"), n, need, F.greatest(F.lit(0), F.col("words") - F.col("len")))
        hits.append(met.select("rid", "doc_id", "len", "k", F.explode(starts).alias("start")))
    if not sizes:
        return hashed.limit(0).select("rid", "doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("start_word"), F.lit(0).alias("n_words"), F.lit(0).alias("bits"))
    item_sh = reduce(DataFrame.unionByName, at_item).groupBy("item_id", "len", "k", "sh").agg(F.count("*").alias("n"))
    item_sh = settle(item_sh, "decontam-item-shingles")
    windows = settle(reduce(DataFrame.unionByName, hits), "decontam-windows")

    # the windows' shingles: a document's windows are at most its shingles times the item lengths
    per_doc = windows.groupBy(F.col("rid").alias("of"), F.col("doc_id").alias("of_id")).agg(F.collect_list(F.struct("len", "k", "start")).alias("spots"))
    # documents are dealt by row key at every size: what they are joined with grows with them
    read = texts.join(per_doc.hint("merge"), (F.col("rid") == F.col("of")) & same_id(F.col("doc_id"), F.col("of_id"))).dropDuplicates(["rid", "doc_id"]).select("rid", "doc_id", word_hashes(F.col("text")).alias("w"), "spots")
    read = read.select("rid", "doc_id", "w", F.explode("spots").alias("s"))
    cut = []
    for k in sizes:
        n = F.least(F.col("s.len"), F.size("w")) - k + 1
        cut.append(read.filter(F.col("s.k") == k).select("rid", "doc_id", F.col("s.len").alias("len"), F.col("s.start").alias("start"), F.explode(shingles(F.col("w"), k, F.col("s.start"), n)).alias("sh")))
    place = ["rid", "doc_id", "len", "start"]
    win_sh = settle(reduce(DataFrame.unionByName, cut).groupBy(*place, "sh").agg(F.count("*").alias("n")), "decontam-window-shingles")

    win_fp = fingerprints(win_sh, place)
    item_fp = fingerprints(item_sh, ["item_id", "len"]).withColumnsRenamed({"fp": "item_fp", "total": "item_total"})
    probes = win_fp.select(*place, "fp", "total", F.inline(block_values(F.col("fp"), 0)))
    stored = item_fp.select("item_id", "len", "item_fp", "item_total", F.inline(block_values(F.col("item_fp"), VARY)))
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    near = probes.join(stored, ["len", "block", "value"]).withColumn("bits", bits).filter(F.col("bits") <= RADIUS)
    near = near.select(*place, "item_id", "total", "item_total", "bits").distinct()

    other = item_sh.select("item_id", "sh", F.col("n").alias("m"))
    parts = win_sh.withColumnRenamed("doc_id", "of_id")
    shared = near.join(parts, ["rid", "len", "start"]).filter(same_id(F.col("doc_id"), F.col("of_id"))).join(other, ["item_id", "sh"])
    verified = shared.groupBy(*place, "item_id", "total", "item_total", "bits").agg(F.sum(F.least("n", "m")).alias("both"))
    alike = F.col("both") / (F.col("total") + F.col("item_total") - F.col("both"))
    verified = verified.withColumn("similarity", alike).filter(F.col("similarity") >= similarity)
    best = F.max_by(F.struct("similarity", "start", "len", "bits"), F.struct("similarity", -F.col("start")))
    return (
        verified.groupBy("rid", "doc_id", "item_id")
        .agg(best.alias("b"))
        .select("rid", "doc_id", "item_id", "b.similarity", F.col("b.start").alias("start_word"), F.col("b.len").alias("n_words"), "b.bits")
    )


def clean(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    found = contaminated(docs, items, similarity).select(F.col("rid").alias("hit_rid"), F.col("doc_id").alias("hit_id")).distinct()
    doc_id = docs["doc_id"].cast("long")
    hit = (row_key(doc_id, docs["text"]) == found["hit_rid"]) & same_id(doc_id, found["hit_id"])
    return docs.join(found, hit, "left_anti")
