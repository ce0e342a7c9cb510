"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. If two fingerprints differ in at most
``bits`` bits, some segment differs in at most ``bits // segments`` of them.
Each fingerprint is stored in one table per segment and looked up there with
every value of the Hamming ball of that radius around its own segment; each
match is verified over the whole fingerprint.

Equal fingerprints are one node, so copies cost nothing. Inside one table
bucket only a spanning forest of the verified links leaves the task, found by
breadth-first search over the fingerprints not yet reached, so that a large
bucket of mutually near fingerprints is neither expanded into pairs nor
compared pair by pair. Buckets around a segment value that many fingerprints
share are cut further by the other bits, so that they spread over tasks and
far fingerprints never meet. Components of the links are found in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, row_key, same_id, settle
from .components import components

#: Shingles hashed at a time: bounds memory on very long texts.
BLOCK = 1 << 16
SEED = 42
#: Fingerprints that may share a segment value before the buckets around it are cut.
HOT = 1024


def fingerprint(text: str | None, words: int) -> int:
    """64-bit SimHash of a text's word shingles, as a signed long."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    data = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    begin = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    last = max(0, len(parts) - words)
    ends = (begin + lengths)[len(parts) - 1 - last :].tolist()
    starts = begin[: last + 1].tolist()
    votes, n = np.zeros(64, np.int64), len(starts)
    hashed = xxhash.xxh64_intdigest
    for k in range(0, n, BLOCK):
        h = np.array([hashed(data[a:b], SEED) for a, b in zip(starts[k : k + BLOCK], ends[k : k + BLOCK])], np.uint64)
        votes += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, rid, fp) of every row, rid being its ``row_key``; a null or
    empty text has fingerprint 0."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array((fingerprint(t.as_py(), words) for t in b["text"]), pa.int64())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["rid"], fp], ["doc_id", "rid", "fp"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = texts.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("rid"), "text")
    return keyed.mapInArrow(run, "doc_id long, rid long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _segment(s: int, segments: int) -> tuple[Column, int]:
    """Value of segment ``s`` of fp, and its width; the last takes what is left."""
    width = 64 // segments
    size = width if s < segments - 1 else 64 - width * (segments - 1)
    return F.shiftrightunsigned("fp", s * width).bitwiseAND(F.lit((1 << size) - 1 if size < 64 else -1)), size


def segment_rows(nodes: DataFrame, bits: int, segments: int) -> DataFrame:
    """(seg, key, fp, stored): each fingerprint's table row of each segment
    (stored) and its lookups, one for each other value of the Hamming ball."""
    tables = []
    for s in range(segments):
        value, size = _segment(s, segments)
        masks = F.array(*[F.lit(_signed(m)) for m in sorted(set(_ball(size, bits // segments)))])
        rows = F.transform(masks, lambda m: F.struct(value.bitwiseXOR(m).alias("key"), (m == 0).alias("stored")))
        tables.append(nodes.select("fp", F.lit(s).alias("seg"), F.inline(rows)))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def cut_hot_buckets(nodes: DataFrame, rows: DataFrame, bits: int, segments: int, hot: int) -> DataFrame:
    """``rows`` with (part, cut): buckets around a segment value that more than
    ``hot`` fingerprints share are cut by the bits outside the segment. These
    are split into ``bits`` + 2 blocks; two fingerprints within ``bits`` agree
    in two of them at least, so a row goes once under each pair of blocks, and
    no link is lost. Other buckets stay whole (part -1)."""
    values = F.array(*[F.struct(F.lit(s).alias("seg"), _segment(s, segments)[0].alias("key")) for s in range(segments)])
    shared = nodes.select(F.inline(values)).groupBy("seg", "key").agg(F.count("*").alias("n")).filter(F.col("n") > hot)
    around, cuts = F.lit(None), F.lit(None)
    for s in range(segments):
        _, size = _segment(s, segments)
        at = s * (64 // segments)
        outside = [b for b in range(64) if not at <= b < at + size]
        blocks = [sum(1 << b for b in part.tolist()) for part in np.array_split(outside, bits + 2)]
        masks = F.array(*[F.lit(_signed(x | y)) for x, y in combinations(blocks, 2)])
        mine = F.transform(masks, lambda m, i: F.struct(i.alias("part"), F.col("fp").bitwiseAND(m).alias("cut")))
        cuts = F.when(F.col("seg") == s, mine).otherwise(cuts)
        ball = F.array(*[F.lit(_signed(m)) for m in sorted(set(_ball(size, bits // segments)))])
        around = F.when(F.col("seg") == s, F.transform(ball, lambda m: F.col("key").bitwiseXOR(m))).otherwise(around)
    found = settle(shared.select(F.col("seg").alias("hot_seg"), F.explode(around).alias("hot_key")).distinct(), "simhash-hot")
    marked = rows.join(found, (F.col("seg") == F.col("hot_seg")) & (F.col("key") == F.col("hot_key")), "left")
    whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("cut")))
    return marked.select("seg", "key", "fp", "stored", F.inline(F.when(F.col("hot_key").isNotNull(), cuts).otherwise(whole)))


def _ball(size: int, radius: int) -> Iterator[int]:
    """All masks of at most ``radius`` of ``size`` bits."""
    yield 0
    if radius > 0:
        for b in range(size):
            for m in _ball(b, radius - 1):
                yield m | 1 << b


def forest(fps: np.ndarray, stored: np.ndarray, bits: int) -> tuple[list, list]:
    """Spanning forest of the links between a bucket's rows; one end of each
    link is a stored row, as in a table lookup."""
    left, right = [], []
    bare = fps.view(np.uint64)  # bit counts of signed numbers leave out the sign
    rest = np.arange(len(fps))
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            f = frontier.pop()
            near = np.bitwise_count(bare[rest] ^ bare[f]) <= bits
            if not stored[f]:
                near &= stored[rest]
            if near.any():
                found = rest[near]
                rest = rest[~near]
                left.extend([fps[f]] * len(found))
                right.extend(fps[found])
                frontier.extend(found)
    return left, right


def links(nodes: DataFrame, bits: int, segments: int, hot: int = HOT) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints that a chain of
    pairs within ``bits`` connects."""
    ready(nodes.sparkSession)
    rows = cut_hot_buckets(nodes, segment_rows(nodes, bits, segments), bits, segments, hot)
    names = ["seg", "key", "part", "cut"]
    dealt = rows.repartition(*names).sortWithinPartitions(*names)

    def bucket_links(bucket: list[np.ndarray], fp: np.ndarray, stored: np.ndarray) -> pd.DataFrame:
        first = np.flatnonzero(np.concatenate(([True], np.any([c[1:] != c[:-1] for c in bucket], axis=0))))
        size = np.diff(np.concatenate((first, [len(fp)])))
        kept = np.add.reduceat(stored.astype(np.int64), first)
        a, b = [], []
        for k in np.flatnonzero((size > 1) & (kept > 0)):
            rows = slice(first[k], first[k] + size[k])
            x, y = forest(fp[rows], stored[rows], bits)
            a += x
            b += y
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append([batch[c].to_numpy() for c in (*names, "fp", "stored")])
            if all(x[0] == y[-1] for x, y in zip(held[0][:4], held[-1][:4])):
                continue  # one bucket so far
            cols = [np.concatenate(x) for x in zip(*held)]
            other = np.any([c[::-1] != c[-1] for c in cols[:4]], axis=0)
            open_at = len(other) - int(np.argmax(other))
            yield bucket_links([c[:open_at] for c in cols[:4]], *[c[:open_at] for c in cols[4:]])
            held = [[c[open_at:] for c in cols]]
        if held:
            cols = [np.concatenate(x) for x in zip(*held)]
            yield bucket_links(cols[:4], *cols[4:])

    return dealt.mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 3, segments: int = 2) -> DataFrame:
    """(doc_id, rid, fp, component_id, root) of every row of ``docs`` (doc_id,
    text); root is the component's smallest fingerprint.

    Fingerprints that differ in at most ``bits`` bits are linked;
    component_id is the smallest doc_id reachable. A null, empty or blank
    text has fingerprint 0 and is linked like any other. Null doc_ids are no
    candidates for component_id; a component of null doc_ids only has a null
    one. Repeated rows are separate rows of one component. An empty table
    gives an empty result. Other columns are not read.
    """
    marked = settle(fingerprints(docs, words), "simhash-fps")
    nodes = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    roots = components(settle(links(nodes.select("fp"), bits, segments).distinct(), "simhash-links"))
    r = roots.withColumnRenamed("node", "fp")
    named = nodes.join(r, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = named.select("fp", "root").join(smallest, "root")
    return marked.join(of, "fp").select("doc_id", "rid", "fp", "component_id", "root")


def keep_one(docs: DataFrame, words: int = 3, bits: int = 3, segments: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, with its smallest
    doc_id (null only if all are; of rows with one doc_id the smallest row key,
    of equal rows the first by their other columns). Texts without words form
    one component, and one of them stays."""
    found = near_duplicates(docs, words, bits, segments)
    lead = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first"))
    lead = lead.select(F.col("first.rid").alias("lead_rid"), F.col("first.doc_id").alias("lead_id"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), row_key(F.col("doc_id").cast("long"), F.col("text")).alias("rid"))
    mine = keyed.join(lead, (F.col("rid") == F.col("lead_rid")) & same_id(F.col("id"), F.col("lead_id")), "left_semi")
    same = Window.partitionBy("rid", "id").orderBy("row")
    return mine.withColumn("n", F.row_number().over(same)).filter("n = 1").select(*[F.col("row")[c].alias(c) for c in docs.columns])
