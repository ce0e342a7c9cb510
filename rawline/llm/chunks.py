"""Substring dedup by content-defined chunking with a gear rolling hash.

The gear hash h = 2 h + G[byte] of 16 bits looks back 16 bytes. A byte ends a
chunk if the hash meets the cut condition there and nowhere in the ``least``
bytes before: whether it does depends on the bytes right before it alone, so
two copies of a passage are cut alike whatever stands before them. Chunks are
deduplicated by digest; of equal chunks the first (smaller doc_id, then
earlier) stays. A run of repeated chunks is taken out if it is long enough to
be no chance meeting of common words, or if it is the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, row_key

#: Bytes of one pass over a text: bounds memory on very long ones.
BLOCK = 1 << 20
#: One byte in CUT meets the cut condition; a chunk has over LEAST bytes (the
#: last of a text may have fewer) and at most MOST.
CUT, LEAST, MOST = 24, 16, 4096
#: Bytes of a run of repeated chunks that is taken out; a shorter one goes if it
#: is the whole text.
RUN = 80


def gear_table(seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear_hashes(part: bytes, gear: np.ndarray) -> np.ndarray:
    """Rolling hash of the 16 bytes up to each byte."""
    h = gear[np.frombuffer(part, np.uint8)]
    for k in (1, 2, 4, 8):  # hash of 2k bytes from hashes of k bytes
        shifted = np.zeros_like(h)
        shifted[k:] = h[:-k] << np.uint16(k)
        h = h + shifted
    return h


def stretch_ends(data: bytes, a: int, b: int, gear: np.ndarray) -> list[int]:
    """Cuts of a stretch without isolated ones: the first least hash in each
    span of MOST / 2 to MOST bytes after the cut before. In a passage that
    repeats itself the cuts fall on the same phase from the second one on,
    wherever the passage begins."""
    out, at = [], a
    while b - at > MOST:
        lo = at + MOST // 2
        h = gear_hashes(data[lo - 15 : at + MOST], gear)[15:]
        at = lo + int(h.argmin()) + 1
        out.append(at)
    return [*out, b]


def chunk_ends(data: bytes, gear: np.ndarray) -> np.ndarray:
    """End positions of the chunks of a text; the last is its length."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    cuts = []
    reach = 16 + LEAST
    for lo in range(0, n, BLOCK):
        begin = max(0, lo - reach)
        hit = gear_hashes(data[begin : lo + BLOCK], gear) < np.uint16(65536 // CUT)  # the high bits depend on all 16 bytes
        at = np.flatnonzero(hit)
        alone = at[np.diff(at, prepend=-LEAST - 1) > LEAST] + begin + 1
        cuts.append(alone[(alone > lo) & (alone > LEAST)])
    ends = np.concatenate((*cuts, [n]))
    ends = np.unique(ends)
    gaps = np.diff(np.concatenate(([0], ends)))
    if (gaps > MOST).any():
        starts = ends - gaps
        ends = np.array([e for a, b in zip(starts.tolist(), ends.tolist()) for e in stretch_ends(data, a, b, gear)], np.int64)
    return ends


#: A chunk, its digest of 128 bits in two halves (last: of its text); in a repeated
#: one, first_id names an earlier copy's document.
CHUNK = "repeated boolean, digest long, more long, size int, doc_id long, start long, rid long, seq int, last boolean, first_id long"
NAMES = [c.split()[0] for c in CHUNK.split(", ")]
NO_ID = -(1 << 63)


def _batch(cols: list[np.ndarray]) -> pa.RecordBatch:
    ids = {NAMES.index("doc_id"), NAMES.index("first_id")}
    return pa.RecordBatch.from_arrays([pa.array(c, mask=c == NO_ID) if i in ids else pa.array(c) for i, c in enumerate(cols)], NAMES)


def _numpy(b: pa.RecordBatch) -> list[np.ndarray]:
    ids = ("doc_id", "first_id")
    return [(b[c].fill_null(NO_ID) if c in ids else b[c]).to_numpy(zero_copy_only=False) for c in NAMES]


def _repeats(cols: list[np.ndarray]) -> np.ndarray:
    """Of chunks in order of (digest, more, size, doc_id, start, rid): which are
    first of their kind; marks those that stand later than it (repeated,
    first_id)."""
    _, digest, more, size, doc_id, start, rid, _, _, _ = cols
    new = np.concatenate(([True], (digest[1:] != digest[:-1]) | (more[1:] != more[:-1]) | (size[1:] != size[:-1])))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    cols[0], cols[-1] = ~new & ((doc_id != doc_id[first]) | (start != start[first]) | (rid != rid[first])), doc_id[first]
    return new


def chunk_rows(docs: DataFrame) -> DataFrame:
    """The chunks of every row. Copies within a batch are told there, so that
    a frequent chunk sends one row of a batch to its digest."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = gear_table()
        for b in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in b["text"].to_pylist()]
            ends = [chunk_ends(t, gear) for t in texts]
            count = [len(e) for e in ends]
            starts = [np.concatenate(([0], e[:-1])) if len(e) else e for e in ends]
            hashed = xxhash.xxh3_128_digest
            digests = b"".join([hashed(t[x:y]) for t, s, e in zip(texts, starts, ends) for x, y in zip(s.tolist(), e.tolist())])
            if not digests:
                continue
            digest, more = np.frombuffer(digests, np.int64).reshape(-1, 2).T
            start = np.concatenate(starts).astype(np.int64)
            size = (np.concatenate(ends) - start).astype(np.int32)
            seq = np.concatenate([np.arange(n, dtype=np.int32) for n in count])
            doc_id, rid = (np.repeat(b[c].fill_null(NO_ID).to_numpy(), count) for c in ("doc_id", "rid"))
            last = seq + 1 == np.repeat(count, count)
            cols = [np.zeros(len(seq), bool), digest, more, size, doc_id, start, rid, seq, last, doc_id.copy()]
            order = np.lexsort((rid, start, doc_id, size, more, digest))
            cols = [c[order] for c in cols]
            new = _repeats(cols)
            yield _batch([c[new | cols[0]] for c in cols])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = texts.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("rid"), "text")
    return keyed.mapInArrow(run, CHUNK)


def repeated_chunks(chunks: DataFrame) -> DataFrame:
    """The chunks with an earlier copy: a stream over rows in order of digest,
    which keeps only the first chunk of the digest at hand."""
    dealt = chunks.withColumn("at", F.when(F.col("repeated"), F.col("rid")).otherwise(F.col("digest")))
    dealt = dealt.repartition("at").drop("at").sortWithinPartitions("repeated", "digest", "more", "size", "doc_id", "start", "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None
        for b in batches:
            cols = _numpy(b)
            known = cols[0]
            if known.any():
                yield _batch([c[known] for c in cols])
                cols = [c[~known] for c in cols]
            if not len(known) or known.all():
                continue
            if first is not None:
                cols = [np.concatenate(([f], c)).astype(c.dtype) for f, c in zip(first, cols)]
            new = _repeats(cols)
            if cols[0].any():
                yield _batch([c[cols[0]] for c in cols])
            first = [c[np.flatnonzero(new)[-1]] for c in cols]
            first[0] = False

    return dealt.mapInArrow(run, CHUNK)


def repeated_runs(docs: DataFrame, least: int = RUN) -> DataFrame:
    """(rid, doc_id, start, size, chunks, first_id): maximal runs of chunks
    that repeat an earlier one, of ``least`` bytes at least or of the whole text; first_id
    is the doc_id of an earlier copy of the run's first chunk."""
    again = repeated_chunks(chunk_rows(docs)).dropDuplicates(["rid", "doc_id", "seq"])
    # a document's own repeated chunks are ordered together, never a digest's
    along = Window.partitionBy("rid", "doc_id").orderBy("seq")
    run = F.col("seq") - F.row_number().over(along)  # the same within a run
    runs = again.withColumn("run", run).groupBy("rid", "doc_id", "run")
    out = runs.agg(F.min("start").alias("start"), F.sum("size").alias("size"), F.count("*").alias("chunks"), F.min_by("first_id", "seq").alias("first_id"), F.max("last").alias("last"))
    return out.filter((F.col("size") >= least) | ((F.col("start") == 0) & F.col("last"))).drop("run", "last")


def without_repeats(docs: DataFrame, least: int = RUN) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_runs, copied_from, kept) of every row of
    ``docs`` (doc_id, text): its text without the runs of chunks that repeat
    earlier ones, and doc_ids that hold earlier copies of the runs.

    Sizes are UTF-8 bytes; a run loses a character that it holds in part. A
    null text counts as empty. Rows that repeat doc_id and text are one
    document, reported for each row; of other rows with one doc_id the earlier
    start, then the smaller row key, counts as first. Null doc_ids come first.
    An empty table gives an empty result. Other columns are not read.
    """
    runs = repeated_runs(docs, least).groupBy(F.col("rid").alias("run_rid"), F.col("doc_id").alias("run_id")).agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias("runs"), F.sort_array(F.collect_set("first_id")).alias("copied_from"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), row_key(F.col("doc_id").cast("long"), F.col("text")).alias("rid"))
    joined = texts.join(runs, (F.col("rid") == F.col("run_rid")) & F.col("doc_id").eqNullSafe(F.col("run_id")), "left").select("doc_id", "text", F.transform("runs", lambda r: r["start"]).alias("starts"), F.transform("runs", lambda r: r["start"] + r["size"]).alias("ends"), "copied_from")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, sizes, removed, n_runs = [], [], [], []
            for text, starts, ends in zip(*(b[c].to_pylist() for c in ("text", "starts", "ends"))):
                data = text.encode("utf-8", "surrogatepass")
                at, parts = 0, []
                for s, e in zip(starts or [], ends or []):
                    while s < e and data[s] & 0xC0 == 0x80:
                        s += 1
                    while e > s and e < len(data) and data[e] & 0xC0 == 0x80:
                        e -= 1
                    parts.append(data[at:s])
                    at = e
                left = b"".join((*parts, data[at:])) if parts else data
                kept.append(left.decode("utf-8", "surrogatepass"))
                sizes.append(len(data))
                removed.append(len(data) - len(left))
                n_runs.append(len(starts or []))
            cols = [b["doc_id"], *(pa.array(x, pa.int64()) for x in (sizes, removed, n_runs)), b["copied_from"], pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "n_removed", "n_runs", "copied_from", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_runs long, copied_from array<bigint>, kept string")
