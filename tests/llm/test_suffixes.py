import hashlib
import random

import numpy as np
import pytest

from rawline.llm import induced, suffixes
from rawline.llm.induced import suffix_order, suffixes_descending
from rawline.llm.suffixes import without_repeated_strings


def test_order_and_common_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(150):
        parts = [rng.integers(2, rng.integers(3, 6), rng.integers(0, 30)) for _ in range(rng.integers(1, 6))]
        t = np.concatenate([np.concatenate((p, [1])) for p in parts] + [[0]]).astype(np.int32)
        depth, n = int(rng.integers(1, 12)), len(t)
        order, com = suffix_order(t, int(t.max()) + 1, depth, in_memory=int(rng.integers(0, 100)))
        assert sorted(order.tolist()) == list(range(n))
        heads = [tuple(t[i : i + depth].tolist()) for i in order]
        assert heads == sorted(heads)
        for k in range(1, n):
            e = 0
            while e < depth and max(order[k], order[k - 1]) + e < n and t[order[k] + e] == t[order[k - 1] + e]:
                e += 1
            assert e == com[k]


def test_queues_far_larger_than_memory(monkeypatch):
    monkeypatch.setattr(induced, "STEP", 1 << 10)
    files = []
    monkeypatch.setattr(induced.tempfile, "TemporaryFile", lambda real=induced.tempfile.TemporaryFile: files.append(real()) or files[-1])
    rng = np.random.default_rng(3)
    words = [rng.integers(2, 30, rng.integers(2, 9)) for _ in range(200)]
    t = np.concatenate([*(words[i] for i in rng.integers(0, 200, 20000)), np.full(3000, 7), [0]])
    room = len(t) // 50
    sizes, order, com = [], [], []
    for pos, c in suffixes_descending(t, 30, 40, room):
        sizes.append(len(pos))
        order.append(pos)
        com.append(c)
    assert files and max(sizes) <= 2 << 10  # handed out in blocks, with entries on disk
    calm = suffix_order(t, 30, 40)
    order = np.concatenate(order)[::-1]
    raw = (t + 1).astype(np.uint8).tobytes()
    heads = [raw[i : i + 40] for i in order.tolist()]
    assert heads == sorted(raw[i : i + 40] for i in range(len(t)))
    assert np.concatenate(com)[::-1][:-1].tolist() == calm[1][1:].tolist()


@pytest.mark.parametrize("room", [0, 50, 2000])
def test_shard_larger_than_its_queues(monkeypatch, room):
    monkeypatch.setattr(suffixes, "IN_MEMORY", room)
    monkeypatch.setattr(induced, "STEP", 64)
    rng = random.Random(room)
    text = corpus(rng, "abc", 80)
    rows = [(i, 7, 0, len(t) - 11, t.encode()) for i, t in text if len(t) >= 12]
    got = suffixes.shard_repeats(rows, 12).to_pydict()
    found = {(i, p + k) for i, p, n in zip(got["doc_id"], got["start"], got["windows"]) for k in range(n)}
    seen, want = set(), set()
    for i, _, _, n, t in rows:
        for j in range(n):
            if t[j : j + 12] in seen:
                want.add((i, j))
            seen.add(t[j : j + 12])
    assert found == want and want


def brute(data, length):
    seen, out = set(), []
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, text in order:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for j in range(len(raw) - length + 1):
            w = raw[j : j + length]
            if w in seen:
                gone[j : j + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, y in zip(raw, gone) if not y)
        out.append((i, len(raw), sum(gone), sum(1 for x in bytes(gone).split(b"\0") if x), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(rng, letters, n):
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))) for _ in range(8)]
    out = []
    for i in range(n):
        t = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))
        if out and rng.random() < 0.4:
            other = rng.choice(out)[1]
            a = rng.randrange(len(other) + 1)
            t = t[: len(t) // 2] + other[a : a + rng.randrange(60)] + t[len(t) // 2 :]
        if rng.random() < 0.2:
            t += rng.choice(words) * rng.randrange(20)
        out.append((i * 3, t))
    return out


@pytest.mark.parametrize("seed,letters,length,gram", [(1, "ab", 12, 4), (2, "abcdé", 10, 8), (3, "a", 16, 2), (4, "abcdefgh", 24, 16)])
def test_equals_brute_force(spark, monkeypatch, seed, letters, length, gram):
    monkeypatch.setattr(suffixes, "BLOCK", 64)
    data = [*corpus(random.Random(seed), letters, 60), (1, None), (2, "")]
    data.append((5, data[10][1]))
    df = spark.createDataFrame([(*d, 1, "x") for d in data], "doc_id long, text string, windows int, part string").repartition(3)
    got = without_repeated_strings(df, length, gram).collect()
    found = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got), key=str)
    assert found == brute(data, length)


def test_hot_keys_are_dealt_anew(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 3)
    monkeypatch.setattr(suffixes, "SLICE", 500)
    data = corpus(random.Random(6), "abcd", 60)
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = without_repeated_strings(df, 14, 4).collect()
    found = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got), key=str)
    assert found == brute(data, 14)


def test_phrase_in_new_contexts_fills_no_shard(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 3)
    shards, real = [], suffixes.repeated_windows
    monkeypatch.setattr(suffixes, "repeated_windows", lambda parts, length: shards.append(parts) or real(parts, length))
    rng = random.Random(8)
    some = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    phrase = some(19)
    data = [(i, some(30) + phrase + "xy"[i % 2] * (i % 3) + some(30)) for i in range(40)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = without_repeated_strings(df, 20, 4).collect()
    found = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got), key=str)
    assert found == brute(data, 20)
    assert (shards[0].filter("part is not null").groupBy("key").count().agg({"count": "max"}).first()[0] or 0) <= 3


def test_repeated_rows_empty_and_null(spark):
    t = "abcdefgh" * 3
    data = [(1, t), (1, t), (None, t), (2, "x" + t), (3, "short")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_removed"]) for r in without_repeated_strings(df, 20, 4).collect()), key=str)
    assert got == sorted([(1, 24), (1, 24), (2, 24), (3, 0), (None, 0)], key=str)
    assert without_repeated_strings(df.limit(0), 20, 4).count() == 0

