"""Suffix-array dedup: every byte of a repeated 100-byte string goes, except
in the string's first occurrence.

The corpus is dealt into shards by content. The least hash among a window's
32-byte grams is the window's key; neighbouring windows with one key make a
piece of text. Equal windows have equal keys, so a shard that holds all pieces
of its keys holds all occurrences of its windows, wherever they stand in the
corpus, and finds every repeat by itself. Pieces that repeat whole are settled
where they meet (all but the first go). The distinct pieces of a key are read
back from the documents and sorted: a shard's suffix array and common prefixes
are induced (``induced.py``), and neighbours in it with a common prefix of 100
bytes are the occurrences of one window.

Work is dealt by key and by document row; no key gathers its copies in one
task, as tasks settle copies that they see before anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, row_key, settle
from .induced import suffixes_descending

#: Bytes of the strings that are compared, and of the grams that deal them.
LENGTH, GRAM = 100, 32
#: Starts hashed at a time; text cut and text sorted together, about; queue
#: entries kept in memory (a full shard has several times as many); pieces of a key from which it is dealt by window (as
#: is one of more than SHARD windows).
BLOCK, SLICE, SHARD, IN_MEMORY, HOT = 1 << 16, 1 << 23, 1 << 22, 1 << 19, 8192
BYTE_HASH = np.random.default_rng(9).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15


def window_keys(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Least mixed hash of the grams of each window of ``data``; all hashes."""
    h, size, power = BYTE_HASH[data], 1, BASE
    while size < gram:  # hashes of twice the length; gram is a power of two
        h = h[:-size] * np.uint64(power) + h[size:]
        power = power * power % (1 << 64)
        size *= 2
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    least, width, have = h, length - gram + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least, h


def pieces_of(data: bytes, begin: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, start in it, windows, key, inner) of the pieces of the
    documents that begin at ``begin`` in ``data``.

    inner: a window may occur twice in the piece. Windows d apart are equal
    only in text of period d; the key's gram then stands at the start of one
    of the piece's windows and, later, at the end of another."""
    n = len(data)
    ends = np.append(begin[1:], n)
    raw = np.frombuffer(data, np.uint8)
    at, keys, opens, closes = [], [], [], []
    last, width = None, length - gram + 1
    for lo in range(0, n - length + 1, BLOCK):
        k, h = window_keys(raw[lo : min(n, lo + BLOCK + length - 1)], length, gram)
        opens.append(np.flatnonzero(h[: len(k)] == k) + lo)
        closes.append(np.flatnonzero(h[width - 1 : width - 1 + len(k)] == k) + lo)
        new = np.empty(len(k), bool)
        new[0] = last is None or k[0] != last
        new[1:] = k[1:] != k[:-1]
        inside = begin[np.searchsorted(begin, lo) : np.searchsorted(begin, lo + len(k))]
        new[inside - lo] = True
        last = k[-1]
        hit = np.flatnonzero(new)
        at.append(hit + lo)
        keys.append(k[hit])
    if not at:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64), np.zeros(0, bool))
    at, keys = np.concatenate(at), np.concatenate(keys)
    doc = np.searchsorted(begin, at, side="right") - 1
    stop = np.minimum(np.append(at[1:], n - length + 1), ends[doc] - length + 1)
    ok = stop > at
    at, doc, stop, keys = at[ok], doc[ok], stop[ok], keys[ok]
    opens, closes = np.append(np.concatenate(opens), n), np.concatenate(([-n], *closes))
    first = opens[np.searchsorted(opens, at)]
    final = closes[np.searchsorted(closes, stop) - 1]
    inner = (first < stop) & (final >= at) & (first < final + width - 1)
    return doc, at - begin[doc], stop - at, keys, inner


def halves(parts: Iterable[bytes]) -> np.ndarray:
    """Digests of 128 bits as two rows of 64-bit integers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), np.int64).reshape(-1, 2).T


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about SLICE bytes of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy())
    at = 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE, side="right")))
        yield batch.slice(at, end - at)
        at = end


#: digest, more: the halves of a piece's digest of 128 bits. A row is named by doc_id and rid.
PIECE = "settled boolean, inner boolean, key long, digest long, more long, doc_id long, rid long, start long, windows int"


def find_pieces(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Pieces of every row (doc_id, rid, text). Copies of a piece within a
    batch are settled there: their key is only their row's."""
    names = [c.split()[0] for c in PIECE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch)):
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in b["text"].to_pylist()]
            long_enough = np.flatnonzero([len(x) >= length for x in raw])
            if not len(long_enough):
                continue
            raw = [raw[i] for i in long_enough]
            begin = np.concatenate(([0], np.cumsum([len(x) for x in raw])[:-1])).astype(np.int64)
            data = b"".join(raw)
            doc, start, windows, key, inner = pieces_of(data, begin, length, gram)
            if not len(doc):
                continue
            a = (begin[doc] + start).tolist()
            e = (begin[doc] + start + windows + length - 1).tolist()
            digest, more = halves(data[x:y] for x, y in zip(a, e))
            ids = b["doc_id"].to_numpy()[long_enough][doc]
            rid = b["rid"].to_numpy()[long_enough][doc]
            key = key.view(np.int64)
            order = np.lexsort((rid, start, ids, more, digest, key))
            key, digest, more, ids, rid, start, windows, inner = (x[order] for x in (key, digest, more, ids, rid, start, windows, inner))
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (digest[1:] != digest[:-1]) | (more[1:] != more[:-1])))
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            done = ~new & ((ids != ids[first]) | (rid != rid[first]) | (start != start[first]))
            keep = new | done
            cols = [done, inner, np.where(done, rid, key), digest, more, ids, rid, start, windows.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cols], names)

    return texts.select("doc_id", "rid", "text").mapInArrow(run, PIECE)


def meet(pieces: DataFrame) -> DataFrame:
    """Copies of a piece beyond the first (settled), and the distinct pieces
    of every key that has several or that may repeat in themselves. A stream over rows in order of key; it
    holds no group."""
    names = [c.split()[0] for c in PIECE.split(", ")]
    dealt = pieces.repartition("key").sortWithinPartitions("settled", "key", "digest", "more", "doc_id", "start", "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None  # the first piece of the digest at hand, and the digests of its key so far
        for b in batches:
            cols = [b[c].to_numpy(zero_copy_only=False) for c in names]
            settled = cols[0]
            if settled.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[settled]) for c in cols], names)
                cols = [c[~settled] for c in cols]
            if not len(cols[0]):
                continue
            before = 0
            if state is not None:
                cols = [np.concatenate(([s], c)) for s, c in zip(state[0], cols)]
                before = state[1]
            _, inner, key, digest, more, ids, rid, start, _ = cols
            new_key = np.concatenate(([True], key[1:] != key[:-1]))
            new = new_key | np.concatenate(([True], (digest[1:] != digest[:-1]) | (more[1:] != more[:-1])))
            heads = np.flatnonzero(new)
            first = heads[np.cumsum(new) - 1]
            again = ~new & ((ids != ids[first]) | (rid != rid[first]) | (start != start[first]))
            group = np.cumsum(new_key) - 1
            count = np.bincount(group[heads])
            if state is not None:
                count[0] += before - 1
            several = new & ((count[group] > 1) | inner)
            if state is not None and (before > 1 or inner[0]):
                several[0] = False  # given out before
            out = again | several
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(again[out]), *(pa.array(c[out]) for c in cols[1:])], names)
            state = ([c[heads[-1]] for c in cols], int(count[-1]))

    return dealt.mapInArrow(run, PIECE)


def read_back(texts: DataFrame, distinct: DataFrame, length: int) -> DataFrame:
    """(key, hot, doc_id, rid, start, windows, part): the text of distinct
    pieces; hot marks keys with many of them, or much text."""
    hot = distinct.groupBy(F.col("key").alias("hot_key")).agg(F.count("*").alias("n"), F.sum("windows").alias("size")).filter((F.col("n") > HOT) | (F.col("size") > SHARD)).select("hot_key")
    marked = distinct.join(hot, F.col("key") == F.col("hot_key"), "left").withColumn("hot", F.col("hot_key").isNotNull())
    wanted = marked.groupBy(F.col("rid").alias("of"), F.col("doc_id").alias("of_id")).agg(F.collect_list(F.struct("key", "start", "windows", "hot")).alias("wanted"))
    joined = texts.join(wanted, (F.col("rid") == F.col("of")) & (F.col("doc_id") == F.col("of_id"))).dropDuplicates(["rid", "doc_id"]).select("doc_id", "rid", F.col("text").cast("binary").alias("data"), "wanted")
    sub = F.expr(f"transform(wanted, w -> struct(w.key as key, w.start as start, w.windows as windows, w.hot as hot, substring(data, cast(w.start + 1 as int), w.windows + {length - 1}) as part))")
    return joined.select("doc_id", "rid", F.inline(sub))


PART = "settled boolean, key long, more long, doc_id long, rid long, start long, windows int, part binary"
PART_NAMES = [c.split()[0] for c in PART.split(", ")]
RUN_NAMES = ["doc_id", "rid", "start", "windows"]


def window_runs(ids: np.ndarray, rid: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """doc_id, rid, start, windows of the runs of neighbouring windows."""
    by = np.lexsort((start, rid, ids))
    i, r, p = ids[by], rid[by], start[by]
    head = np.flatnonzero(np.concatenate(([True], (np.diff(i) != 0) | (np.diff(r) != 0) | (np.diff(p) != 1)))) if len(r) else np.zeros(0, np.int64)
    return [i[head], r[head], p[head], np.diff(np.append(head, len(r))).astype(np.int32)]


def deal_hot(parts: DataFrame, length: int) -> DataFrame:
    """Pieces of hot keys (a phrase shorter than a window may stand in any
    number of contexts) are dealt by window: a row without text for the first
    of a batch's equal windows, its hash the key; the later ones are settled
    in runs, their key only their row's."""

    def windows_of(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        count = b["windows"].to_numpy()
        piece = np.repeat(np.arange(len(count)), count)
        digest, more = halves(t[i : i + length] for t, n in zip(b["part"].to_pylist(), count.tolist()) for i in range(n))
        place = b["start"].to_numpy()[piece] + np.concatenate([np.arange(n) for n in count])
        ids, rid = b["doc_id"].to_numpy()[piece], b["rid"].to_numpy()[piece]
        by = np.lexsort((rid, place, ids, more, digest))
        again = np.concatenate(([False], (digest[by][1:] == digest[by][:-1]) & (more[by][1:] == more[by][:-1])))
        head, gone = by[~again], by[again]
        cols = [np.zeros(len(head), bool), digest[head], more[head], ids[head], rid[head], place[head], np.ones(len(head), np.int32)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.nulls(len(head), pa.binary())], PART_NAMES)
        i, r, p, n = window_runs(ids[gone], rid[gone], place[gone])
        cols = [np.ones(len(r), bool), r, np.zeros(len(r), np.int64), i, r, p, n]
        yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.nulls(len(r), pa.binary())], PART_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hot = b["hot"].to_numpy(zero_copy_only=False)
            cold = b.filter(pa.array(~hot))
            none = np.zeros(len(cold), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(none != 0), cold["key"], pa.array(none), *(cold[c] for c in PART_NAMES[3:])], PART_NAMES)
            warm = b.filter(pa.array(hot))
            lot = np.cumsum(warm["windows"].to_numpy().astype(np.int64)) // (SLICE >> 4)
            for at in np.flatnonzero(np.diff(lot, prepend=-1)).tolist():
                yield from windows_of(warm.slice(at, int(np.searchsorted(lot, lot[at], side="right")) - at))

    return parts.mapInArrow(run, PART)


def repeated_windows(parts: DataFrame, length: int) -> DataFrame:
    """(doc_id, rid, start, windows): runs of windows of the pieces that occur earlier
    in another piece of their key, by the shards' suffix arrays. Windows dealt
    by themselves stream by in order; no group of them is held."""
    dealt = parts.repartition("key").sortWithinPartitions(F.col("part").isNull(), "settled", "key", "more", "doc_id", "start", "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, key, window = [], 0, None, None
        for b in batches:
            alone = b["part"].is_null().to_numpy(zero_copy_only=False)
            if alone.any():
                w = b.filter(pa.array(alone))
                digest, more = w["key"].to_numpy(), w["more"].to_numpy()
                again = w["settled"].to_numpy(zero_copy_only=False) | np.concatenate(([window == (digest[0], more[0])], (digest[1:] == digest[:-1]) & (more[1:] == more[:-1])))
                window = digest[-1], more[-1]
                w = w.filter(pa.array(again))
                yield pa.RecordBatch.from_arrays([w[c] for c in RUN_NAMES], RUN_NAMES)
                b = b.filter(pa.array(~alone))
            for row in zip(*(b[c].to_pylist() for c in ("key", "doc_id", "rid", "start", "windows", "part"))):
                if size >= SHARD and row[0] != key:
                    yield shard_repeats(held, length)
                    held, size = [], 0
                held.append(row[1:])
                size += len(row[5])
                key = row[0]
        if held:
            yield shard_repeats(held, length)

    return dealt.mapInArrow(run, "doc_id long, rid long, start long, windows int")


def shard_repeats(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Repeats within one shard: rows (doc_id, rid, start, windows, part)."""
    ids, rid, start, windows, parts = zip(*rows)
    ids, rid = np.array(ids, np.int64), np.array(rid, np.int64)
    start, windows = np.array(start, np.int64), np.array(windows, np.int64)
    begin = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))
    text = np.append(np.frombuffer(b"".join(p + b"\0" for p in parts), np.uint8).astype(np.int16) + 2, np.int16(0))
    text[begin[1:] - 1] = 1  # a piece's end
    groups, places, group = [], [], 0
    last, last_own, last_joined = -1, False, False  # the suffix before the block
    for pos, com in suffixes_descending(text, 258, length, IN_MEMORY):
        piece = np.minimum(np.searchsorted(begin, pos, side="right") - 1, len(parts) - 1)
        own = pos - begin[piece] < windows[piece]
        joined = (com >= length) & own
        joined &= np.concatenate(([last_own], own[:-1]))
        number = group + np.cumsum(~joined)
        several = joined.copy()
        several[:-1] |= joined[1:]
        if joined[0] and not last_joined:
            groups.append(np.array([group]))
            places.append(np.array([last]))
        groups.append(number[several])
        places.append(pos[several])
        group, last, last_own, last_joined = int(number[-1]), int(pos[-1]), bool(own[-1]), bool(joined[-1])
    group, at = np.concatenate(groups), np.concatenate(places)
    piece = np.searchsorted(begin, at, side="right") - 1
    place = start[piece] + at - begin[piece]
    by = np.lexsort((rid[piece], place, ids[piece], group))
    first = np.concatenate(([True], np.diff(group[by]) != 0)) if len(by) else np.zeros(0, bool)
    gone = by[~first]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in window_runs(ids[piece[gone]], rid[piece[gone]], place[gone])], RUN_NAMES)


def without_repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row of ``docs``
    (doc_id, text): its UTF-8 bytes without each byte covered by a string of
    ``length`` bytes that also starts earlier (smaller doc_id, or earlier in
    the same document); ``kept`` is binary, as a cut may split a character.

    A null text counts as empty. Rows that repeat doc_id and text are one
    document, reported for each row; of other rows that share a doc_id the
    earlier start, then the smaller row key, counts as earlier. Null doc_ids
    come first. An empty table gives an empty result. Other columns are not
    read.
    """
    ready(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long").alias("given_id"), F.coalesce("text", F.lit("")).alias("text"), row_key(F.col("doc_id").cast("long"), F.col("text")).alias("rid"))
    texts = named.select("given_id", F.coalesce("given_id", F.lit(-(1 << 63))).alias("doc_id"), "text", "rid")  # null doc_ids come first
    met = settle(meet(find_pieces(texts, length, gram)), "suffix-met")
    distinct = met.filter("not settled").select("key", "doc_id", "rid", "start", "windows")
    found = repeated_windows(deal_hot(read_back(texts, distinct, length), length), length)
    marks = met.filter("settled").select(*RUN_NAMES).union(found)
    spans = marks.groupBy(F.col("rid").alias("of"), F.col("doc_id").alias("of_id")).agg(F.collect_list(F.struct("start", "windows")).alias("marks"))
    joined = texts.join(spans, (F.col("rid") == F.col("of")) & (F.col("doc_id") == F.col("of_id")), "left").select(F.col("given_id").alias("doc_id"), "text", F.transform("marks", lambda m: m["start"]).alias("starts"), F.transform("marks", lambda m: m["windows"]).alias("windows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, sizes, removed, spans = [], [], [], []
            for text, starts, windows in zip(*(b[c].to_pylist() for c in ("text", "starts", "windows"))):
                data = text.encode("utf-8", "surrogatepass")
                left, n = data, 0
                if starts:
                    at, parts = 0, []
                    for s, e in merged(starts, windows, length):
                        parts.append(data[at:s])
                        at = e
                        n += 1
                    left = b"".join((*parts, data[at:]))
                kept.append(left)
                sizes.append(len(data))
                removed.append(len(data) - len(left))
                spans.append(n)
            cols = [b["doc_id"], *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def merged(starts: list[int], windows: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the windows cover."""
    out: list[list[int]] = []
    for s, n in sorted(zip(starts, windows)):
        e = s + n + length - 1
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]
