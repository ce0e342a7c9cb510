import random

import numpy as np
from conftest import rows

from rawline.llm.chunks import CUT, LEAST, MOST, chunk_ends, gear_table, repeated_runs, without_repeats


def plain_ends(data, gear):
    hits, out, h = [], [], []
    for i in range(len(data)):
        v = 0
        for j in range(max(0, i - 15), i + 1):
            v = (v * 2 + int(gear[data[j]])) % (1 << 16)
        if v < (1 << 16) // CUT:
            hits.append(i)
    for k, i in enumerate(hits):
        if (k == 0 or i - hits[k - 1] > LEAST) and i + 1 > LEAST:
            out.append(i + 1)
    ends = sorted({*out, len(data)} if data else set())
    full, at = [], 0
    for e in ends:
        while e - at > MOST:  # the first least hash of MOST / 2 to MOST bytes on
            def value(i):
                v = 0
                for j in range(max(0, i - 15), i + 1):
                    v = (v * 2 + int(gear[data[j]])) % (1 << 16)
                return v

            at = min(range(at + MOST // 2, at + MOST), key=value) + 1
            full.append(at)
        full.append(e)
        at = e
    return full


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéioustnr") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_chunks_equal_brute_force(monkeypatch):
    import rawline.llm.chunks as m

    rng, gear = random.Random(1), gear_table()
    for size in (0, 1, 15, 40, 3000):
        data = prose(rng, size).encode()[:size]
        assert chunk_ends(data, gear).tolist() == plain_ends(data, gear)
    monkeypatch.setattr(m, "BLOCK", 64)
    data = prose(rng, 800).encode()
    assert chunk_ends(data, gear).tolist() == plain_ends(data, gear)
    assert chunk_ends(b"a" * 10_000, gear).tolist() == plain_ends(b"a" * 10_000, gear)


def test_cuts_resist_shifts():
    rng, gear = random.Random(2), gear_table()
    data = prose(rng, 600).encode()
    cuts = set(chunk_ends(data, gear).tolist())
    moved = {e - 11 for e in chunk_ends(b"hello world" + data, gear).tolist()}
    assert {c for c in cuts if c > 64} == {c for c in moved if c > 64}


def test_passages_are_found_and_clean_text_stays(spark):
    rng = random.Random(7)
    data, planted = [], {}
    for p in range(30):
        passage = prose(rng, rng.randrange(55, 90))
        for k in range(rng.choice([2, 3])):
            planted[len(data)] = (p, k)
            data.append((len(data), prose(rng, rng.randrange(5, 80)) + " " + passage + " " + prose(rng, rng.randrange(5, 80))))
    clean = len(data)
    data += [(clean + i, prose(rng, 120)) for i in range(60)]
    data += [(900, None), (901, ""), (None, "x"), (902, data[clean][1]), (902, data[clean][1])]
    df = spark.createDataFrame([(*d, 3, "s") for d in data], "doc_id long, text string, start int, runs string").repartition(5)
    got = {r["doc_id"]: r for r in without_repeats(df).collect()}
    hit = [got[i]["n_removed"] > 0 for i, (_, k) in planted.items() if k]
    assert np.mean(hit) >= 0.95
    for i, (p, k) in planted.items():
        assert not k or not got[i]["n_removed"] or all(planted[j][0] == p and j < i for j in got[i]["copied_from"])
    assert all(got[i]["n_removed"] == 0 and got[i]["kept"] == (t or "") for i, t in data if i is not None and i < 902 and (i >= clean or planted[i][1] == 0))
    assert got[902]["n_removed"] == got[902]["n_bytes"] == len(data[clean][1].encode()) and got[902]["kept"] == ""
    assert without_repeats(df).count() == len(data)
    assert without_repeats(df.limit(0)).count() == 0
    for r in rows(repeated_runs(df), "doc_id", "start", "size", "first_id"):
        text = dict(data)[r[0]].encode()[r[1] : r[1] + r[2]]
        assert text[:40] in dict(data)[r[3]].encode()


def test_cut_keeps_characters_whole(spark):
    rng = random.Random(3)
    passage = " ".join("".join(rng.choice("éüñßø") for _ in range(6)) for _ in range(120))
    df = spark.createDataFrame([(1, "é" + passage), (2, "aü" + passage + "ñ")], "doc_id long, text string")
    kept = dict(rows(without_repeats(df), "doc_id", "kept"))
    assert kept[1] == "é" + passage and kept[2].startswith("aü") and len(kept[2]) < len(passage) / 4


def test_short_copies_go(spark):
    rng = random.Random(11)
    short = [prose(rng, 9)[:n] for n in (1, 15, 40, 60)]
    data = list(enumerate([*short, *short, short[3] + " and more", "x"])) + [(None, ""), (20, "")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in without_repeats(df).collect()}
    assert all(got[i]["kept"] == short[i] and got[i + 4]["kept"] == "" and got[i + 4]["copied_from"] == [i] for i in range(4))
    assert got[8]["kept"] == short[3] + " and more" and got[9]["kept"] == "x" and got[20]["n_runs"] == 0


def test_a_repeated_line_is_cut_alike_at_any_offset():
    """A passage of one line over and over has no isolated cuts."""
    from rawline.llm.chunks import chunk_ends, gear_table

    rng = random.Random(3)
    gear = gear_table()
    cover = []
    for _ in range(60):
        line = "".join(rng.choice("abcdefghij klmnop") for _ in range(rng.randint(3, 40))).encode() + b"\n"
        passage = (line * (15000 // len(line) + 1))[:15000]
        shares = []
        for _ in range(2):
            text = bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyz ") for _ in range(rng.randint(0, 3000))) + passage
            ends = chunk_ends(text, gear).tolist()
            shares.append({text[a:b]: b - a for a, b in zip([0, *ends], ends)})
        both = shares[0].keys() & shares[1].keys()
        text_chunks = [text[a:b] for a, b in zip([0, *ends], ends)]
        cover.append(sum(len(c) for c in text_chunks if c in both) / 15000)
    assert sum(c == 0 for c in cover) == 0 and sum(cover) / len(cover) > 0.6
