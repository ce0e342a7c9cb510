"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are lengthened by one component so that all have the same norm; the
largest inner product with a query is then the smallest Euclidean distance.
Each table hashes a vector with several p-stable functions
floor((a.x + b) / width); a query visits its own bucket and then the buckets
around it, in the order of their estimated success (the squared distances to
the borders that a perturbation crosses). The candidates that a bucket gives
are scored exactly, in double precision, where the bucket is; the tables'
candidates meet per query.

The number of functions follows the number of vectors, so that buckets keep
their size; the number of probes is the smallest that reaches the wanted
recall on a bounded sample (neighbours within a sample are farther away, so
the whole table does no worse). Equal vectors are one entry with its smallest
ids. A large bucket is cut into slices that different tasks hold, each query
visiting all of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, settle

#: Width of a hash cell in units of the common norm.
WIDTH = 2.5
#: Vectors of a bucket, about, and most in one slice of it.
BUCKET = 512
SLICE = 8192
#: The sample that probes are fitted on: vectors, queries, and most probes.
SAMPLE, SAMPLE_QUERIES, MOST_PROBES = 4096, 128, 4096


def functions_for(n: int) -> int:
    """Hash functions of a table: about three cells a function are in use."""
    return max(1, round(math.log(max(1.0, n / BUCKET)) / math.log(2.6)))


def projections(dim: int, tables: int, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim, tables, k])
    return rng.standard_normal((tables, dim + 1, k)), rng.uniform(0, WIDTH, (tables, k))


def lengthened(x: np.ndarray, norm: float) -> np.ndarray:
    """Rows scaled by ``norm`` (the largest) and lengthened to norm 1."""
    y = x / norm
    return np.hstack((y, np.sqrt(np.maximum(0.0, 1.0 - (y * y).sum(axis=1)))[:, None]))


def turned(q: np.ndarray) -> np.ndarray:
    """Queries scaled to norm 1, with 0 as their last component."""
    return np.hstack((q / np.linalg.norm(q, axis=1)[:, None], np.zeros((len(q), 1))))


def probe_masks(frac: np.ndarray, most: int) -> list[list[tuple[int, int]]]:
    """Perturbations (function, -1 or 1) in order of estimated success."""
    items = sorted([(f * f, j, -1) for j, f in enumerate(frac)] + [((1 - f) ** 2, j, 1) for j, f in enumerate(frac)])
    out: list[list[tuple[int, int]]] = [[]]
    heap = [(items[0][0], (0,))]
    while heap and len(out) < most:
        s, group = heapq.heappop(heap)
        last = group[-1]
        if len({items[g][1] for g in group}) == len(group):
            out.append([items[g][1:] for g in group])
        if last + 1 < len(items):
            heapq.heappush(heap, (s - items[last][0] + items[last + 1][0], (*group[:-1], last + 1)))
            heapq.heappush(heap, (s + items[last + 1][0], (*group, last + 1)))
    return out


def fit_probes(sample: np.ndarray, norm: float, k: int, tables: int, recall: float, near: int, seed: int) -> int | None:
    """Probes a table that reach ``recall`` within the sample; None if more
    than MOST_PROBES would be needed."""
    if len(sample) < 2:
        return 1
    x, q = lengthened(sample, norm), turned(sample[:SAMPLE_QUERIES])
    a, b = projections(sample.shape[1], tables, k, seed)
    s = q @ x.T
    s[np.arange(len(q)), np.arange(len(q))] = -np.inf
    nearest = np.argsort(-s, axis=1)[:, : min(near, len(sample) - 1)]
    best = np.full(nearest.shape, MOST_PROBES, np.int64)
    for t in range(tables):
        cells = np.floor((x @ a[t] + b[t]) / WIDTH).astype(np.int64)
        y = (q @ a[t] + b[t]) / WIDTH
        home = np.floor(y).astype(np.int64)
        for i in range(len(q)):
            rank = {}
            for r, mask in enumerate(probe_masks(y[i] - home[i], MOST_PROBES)):
                at = home[i].copy()
                for j, d in mask:
                    at[j] += d
                rank.setdefault(at.tobytes(), r)
            best[i] = np.minimum(best[i], [rank.get(cells[v].tobytes(), MOST_PROBES) for v in nearest[i]])
    need = int(np.quantile(best, recall, method="higher"))
    return None if need >= MOST_PROBES else need + 1


def search(
    vectors: DataFrame,
    query_ids: Column,
    near: int = 20,
    tables: int = 2,
    recall: float = 0.96,
    seed: int = 7,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``near`` nearest rows found for each
    row that the condition ``query_ids`` holds for, its own id left out.

    ``vectors`` needs vec_id and embedding. Vectors that are null, empty, zero
    or hold null or non-finite components take no part, neither do rows with a
    null vec_id; vectors meet only others of their length. A row repeated
    whole counts once; a vec_id with several vectors is a candidate with each
    and a query with each (then its results are listed once per vector). Ties
    go to the smaller vec_id. An empty table gives an empty result. Other
    columns are not read.
    """
    spark = vectors.sparkSession
    ready(spark)
    emb = F.col("embedding").cast("array<double>")
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(emb, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.filter(usable).select(F.col("vec_id").cast("long").alias("vec_id"), emb.alias("v"), F.coalesce(query_ids, F.lit(False)).alias("asks"))
    rows = rows.filter(F.exists("v", lambda v: v != 0)).withColumn("vkey", F.xxhash64("v", F.lit(1)))
    rows = settle(rows, "ann-rows")

    # one entry per distinct vector, with its near + 1 smallest ids
    mine = Window.partitionBy("vkey", "v").orderBy("vec_id")
    ids = rows.select("vkey", "v", "vec_id").distinct().withColumn("n", F.row_number().over(mine)).filter(F.col("n") <= near + 1)
    entries = ids.groupBy("vkey", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = rows.filter("asks").select("vkey", "v").distinct().withColumn("asked", F.lit(True))
    entries = settle(entries.join(asked, ["vkey", "v"], "left").withColumn("asked", F.coalesce("asked", F.lit(False))), "ann-entries")

    stats = entries.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("norm")).first()
    n, norm = stats["n"], float(stats["norm"] or 1.0)
    dim = (entries.select(F.size("v").alias("d")).groupBy("d").count().orderBy(F.desc("count"), "d").first() or [1])[0]
    sampled = entries.filter(F.size("v") == dim).orderBy(F.xxhash64("vkey"), "vkey").limit(SAMPLE).select("v").collect()  # bounded
    sample = np.array([r["v"] for r in sampled], float).reshape(-1, dim)
    k = functions_for(n)
    while (probes := fit_probes(sample, norm, k, tables, recall, near, seed)) is None:
        k -= 1  # larger buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple] = {}
        for batch in batches:
            out = {c: [] for c in ("tab", "bucket", "vkey", "asks", "v")}
            for key, v, asked in zip(*(batch[c].to_pylist() for c in ("vkey", "v", "asked"))):
                x = np.array([v], float)
                a, b = made.get(len(v)) or made.setdefault(len(v), projections(len(v), tables, k, seed))
                for t in range(tables):
                    cell = np.floor((lengthened(x, norm)[0] @ a[t] + b[t]) / WIDTH).astype(np.int64)
                    spots = [(cell, False)]
                    if asked:
                        y = (turned(x)[0] @ a[t] + b[t]) / WIDTH
                        home = np.floor(y).astype(np.int64)
                        for mask in probe_masks(y - home, probes):
                            at = home.copy()
                            for j, d in mask:
                                at[j] += d
                            spots.append((at, True))
                    for at, asks in spots:
                        out["tab"].append(t)
                        out["bucket"].append(hash((len(v), *at.tolist())) & 0x7FFFFFFFFFFFFFFF)
                        out["vkey"].append(key)
                        out["asks"].append(asks)
                        out["v"].append(v)
                if len(out["tab"]) > 20_000:
                    yield _batch(out)
                    out = {c: [] for c in out}
            yield _batch(out)

    spots = entries.select("vkey", "v", "asked").mapInArrow(run, "tab int, bucket long, vkey long, asks boolean, v array<double>")
    spots = settle(spots, "ann-spots")
    large = spots.filter("not asks").groupBy("tab", "bucket").count().filter(F.col("count") > SLICE)
    large = large.select("tab", "bucket", F.ceil(F.col("count") / SLICE).cast("int").alias("slices"))
    cut = spots.join(large, ["tab", "bucket"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.array(F.pmod("vkey", F.col("slices").cast("long")).cast("int"))
    cut = cut.withColumn("part", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("slices") - 1)).otherwise(own))).drop("slices")
    dealt = cut.repartition("tab", "bucket", "part").sortWithinPartitions("tab", "bucket", "part", "asks")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        kept = 0
        for (_, stored, keys, qkeys, queries) in _buckets(batches):
            if not len(stored) or not len(queries):
                continue
            for lo in range(0, len(queries), 1024):
                s = queries[lo : lo + 1024] @ stored.T
                m = min(near + 1, s.shape[1])
                edge = -np.partition(-s, m - 1, axis=1)[:, m - 1 : m]
                r, c = np.nonzero(s >= edge)  # ties at the edge stay
                held.append((qkeys[lo + r], keys[c], s[r, c]))
                kept += len(r)
            if kept > 2_000_000:
                best = _best(held, near + 1)
                held, kept = [best], len(best[0])
                if kept > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], ["qkey", "vkey", "score"])
                    held, kept = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _best(held, near + 1)], ["qkey", "vkey", "score"])

    found = settle(dealt.mapInArrow(scan, "qkey long, vkey long, score double").groupBy("qkey", "vkey").agg(F.max("score").alias("score")), "ann-found")

    # a query that its buckets gave too few candidates reads all entries, in blocks
    enough = found.join(entries.select("vkey", F.size("ids").alias("m")), "vkey").groupBy("qkey").agg(F.sum("m").alias("m")).filter(F.col("m") > near)
    short = settle(entries.filter("asked").join(enough, F.col("vkey") == F.col("qkey"), "left_anti").select("vkey", "v"), "ann-short")
    if short.limit(1).count():
        blocks = max(1, math.ceil(n / SLICE))
        place = [F.lit(0).alias("tab"), F.size("v").cast("long").alias("bucket")]
        every = entries.select(*place, F.pmod("vkey", F.lit(blocks)).cast("int").alias("part"), "vkey", F.lit(False).alias("asks"), "v")
        asking = short.select(*place, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("part"), "vkey", F.lit(True).alias("asks"), "v")
        again = every.union(asking).select(*cut.columns).repartition("tab", "bucket", "part").sortWithinPartitions("tab", "bucket", "part", "asks")
        more = again.mapInArrow(scan, "qkey long, vkey long, score double")
        found = settle(found.union(more).groupBy("qkey", "vkey").agg(F.max("score").alias("score")), "ann-found-all")
    hits = found.join(entries.select("vkey", "ids"), "vkey").select("qkey", F.explode("ids").alias("vec_id"), "score")
    best = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    hits = hits.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= near + 1).drop("n")
    asking = rows.filter("asks").select(F.col("vec_id").alias("query_id"), F.col("vkey").alias("qkey")).distinct()
    listed = asking.join(hits, "qkey").filter(F.col("vec_id") != F.col("query_id"))
    of = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    return listed.withColumn("rank", F.row_number().over(of)).filter(F.col("rank") <= near).select("query_id", "rank", "vec_id", "score")


def _batch(out: dict[str, list]) -> pa.RecordBatch:
    kinds = {"tab": pa.int32(), "asks": pa.bool_(), "v": pa.list_(pa.float64())}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()], list(out))


def _best(held: list[tuple], near: int) -> tuple:
    """The ``near`` best distinct entries of each query, with ties."""
    q, v, s = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((-s, v, q))  # a pair that several tables gave: once
    q, v, s = q[order], v[order], s[order]
    new = np.concatenate(([True], (q[1:] != q[:-1]) | (v[1:] != v[:-1])))
    q, v, s = q[new], v[new], s[new]
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
    group = np.cumsum(np.concatenate(([False], q[1:] != q[:-1])))
    place = np.arange(len(q)) - first[group]
    edge = np.minimum(first + near - 1, np.concatenate((first[1:], [len(q)])) - 1)
    keep = (place < near) | (s == s[edge][group])
    return q[keep], v[keep], s[keep]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(place, stored vectors, their keys, query keys, queries) of each run of
    equal (tab, bucket, part), stored rows first."""
    place, stored, keys, qkeys, queries = None, [], [], [], []

    def done() -> tuple:
        return place, np.array(stored, float), np.array(keys, np.int64), np.array(qkeys, np.int64), np.array(queries, float)

    for b in batches:
        flat = b["v"].flatten().to_numpy(zero_copy_only=False)
        ends = b["v"].offsets.to_numpy()
        ends = ends - ends[0]
        cols = [b[c].to_pylist() for c in ("tab", "bucket", "part", "asks", "vkey")]
        for i, (t, u, p, asks, key) in enumerate(zip(*cols)):
            if (t, u, p) != place:
                if place is not None:
                    yield done()
                place, stored, keys, qkeys, queries = (t, u, p), [], [], [], []
            (queries if asks else stored).append(flat[ends[i] : ends[i + 1]])
            (qkeys if asks else keys).append(key)
    if place is not None:
        yield done()
