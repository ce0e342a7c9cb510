import random

import numpy as np
import pytest
import xxhash
from conftest import rows
from pyspark.sql import functions as F

from rawline.llm.components import components
from rawline.llm.simhash import cut_hot_buckets, fingerprint, forest, keep_one, links, near_duplicates, segment_rows


def plain_fingerprint(text, n=3):
    words = [w for w in (text or "").encode().lower().split() if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


TEXTS = ["", None, " \n", "One", "one", "a b", "ä ö ü Ü", "x " * 70_000, "A b  C\td e\x0bf g", "a b c d e f g"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert fingerprint(text, 3) % (1 << 64) == plain_fingerprint(text)


def corpus():
    rng = random.Random(3)
    out = []
    for g in range(40):
        words = [rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randrange(50)) for _ in range(120)]
        for _ in range(rng.choice([1, 1, 2, 6])):
            near = list(words)
            for _ in range(rng.randrange(3)):
                near[rng.randrange(len(near))] = "edit"
            out.append((len(out) + 10, " ".join(near)))
    return out + [(1, None), (2, ""), (3, " "), (3, " "), (None, "x"), (None, "x y")]


def test_components_equal_brute_force(spark):
    data = corpus()
    df = spark.createDataFrame([(i, t, 0, "c") for i, t in data], "doc_id long, text string, fp int, root string")
    got = near_duplicates(df)
    fps = {plain_fingerprint(t) for _, t in data}
    root = plain_components(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for i, t in data:
        if i is not None:
            r = root[plain_fingerprint(t)]
            first[r] = min(first.get(r, i), i)
    want = sorted(((i, first.get(root[plain_fingerprint(t)])) for i, t in data), key=str)
    assert sorted(rows(got, "doc_id", "component_id"), key=str) == want
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(root.values()))
    assert {r[0] for r in rows(kept, "doc_id") if r[0]} <= set(first.values())


@pytest.mark.parametrize("bits,segments", [(3, 2), (4, 2), (3, 4), (5, 3)])
def test_links_connect_all_within_the_radius(spark, bits, segments):
    rng = random.Random(bits)
    nodes = set()
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(6):
            nodes.add(x)
            for _ in range(rng.randrange(1, bits + 2)):
                x ^= 1 << rng.randrange(64)
    signed = {n - (1 << 64) if n >> 63 else n for n in nodes}
    df = spark.createDataFrame([(n,) for n in signed], "fp long")
    found = links(df, bits, segments).collect()
    assert all((r["a"] ^ r["b"]) % (1 << 64) and ((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= bits for r in found)
    roots = dict(rows(components(links(df, bits, segments).distinct())))
    want = plain_components(sorted(signed), lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= bits)
    assert {n: roots.get(n, n) for n in signed} == want


@pytest.mark.parametrize("bits,segments", [(3, 2), (5, 3)])
def test_hot_segments_are_cut_without_losing_links(spark, bits, segments):
    """A third of the fingerprints share one segment and are mostly far apart
    in the rest; the rest is spread. No sub-bucket of the hot one is large."""
    rng = random.Random(7)
    width = 64 // segments
    nodes = {rng.getrandbits(64) for _ in range(400)}
    for _ in range(60):
        x = rng.getrandbits(64 - width) << width | 5
        for _ in range(4):
            nodes.add(x)
            x ^= 1 << rng.randrange(width, 64)
            if rng.random() < 0.3:
                nodes.add(x ^ 1 << rng.randrange(width))
    signed = {n - (1 << 64) if n >> 63 else n for n in nodes}
    df = spark.createDataFrame([(n,) for n in signed], "fp long")
    cut = cut_hot_buckets(df, segment_rows(df, bits, segments), bits, segments, 50)
    largest = {(r["hot"]): r["m"] for r in cut.groupBy("seg", "key", "part", "cut").count().groupBy((F.col("part") >= 0).alias("hot")).agg(F.max("count").alias("m")).collect()}
    assert largest[True] <= 40 < 200 < cut.filter("seg = 0 and key = 5 and part = 0").count()
    want = plain_components(sorted(signed), lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= bits)
    for hot in (0, 50, 10**6):
        roots = dict(rows(components(links(df, bits, segments, hot).distinct())))
        assert {n: roots.get(n, n) for n in signed} == want


def test_forest_only_links_through_stored_rows():
    fps = np.array([0, 1, 3, 7], np.int64)
    a, b = forest(fps, np.array([False, False, False, True]), 1)
    assert list(zip(a, b)) == [(3, 7)]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert near_duplicates(df).count() == 0
    assert keep_one(df).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 160)]
    got = dict(rows(components(spark.createDataFrame(path, "a long, b long"))))
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}
