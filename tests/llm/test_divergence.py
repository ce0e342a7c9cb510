import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rawline.llm import divergence
from rawline.llm.divergence import divergences, shares

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs):
    langs = defaultdict(list)
    for text, lang, source in docs:
        langs[lang or ""].append((source or "", TERM.findall((text or "").translate(LOW))))
    out = []
    for lang, own in langs.items():
        df = Counter(t for _, ts in own for t in set(ts))
        kept = {t for t, n in df.items() if n >= 3}
        count = defaultdict(Counter)
        whole = Counter()
        for s, ts in own:
            count[s].update(t for t in ts if t in kept)
            whole.update(t for t in ts if t in kept)

        def p(c):
            n = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // n for t in kept}

        q = p(whole)
        share = {s: p(c) for s, c in count.items()}
        for s in share:
            pairs = [(o, sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept)) for o in share if o != s]
            terms = [(t, (share[s][t] - q[t]) ** 2 // q[t]) for t in kept if count[s][t] and share[s][t] > q[t]]
            for part, found, top in (("pair", pairs, None), ("term", terms, 200)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(found[:top])]
    return sorted(out)


def made(n=400, seed=1):
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in ("Ab", "éÉ", "z", "漢字", "ſ") for b in ("", "x", "İ", "ō", "Q")]
    seps = [" ", "\n", "1", "\x00", "@[`{\x7f", "_", "-"]
    docs = []
    for k in range(n):
        lang = [None, "en", "de", "x"][min(3, int(rng.integers(0, 4)))]
        source = None if k % 17 == 0 else f"s{int(rng.integers(0, 6)) if k % 3 else 0}"
        text = "".join(words[int(w)] + seps[int(s)] for w, s in zip(rng.zipf(1.4, 12) % len(words), rng.integers(0, len(seps), 12)))
        docs.append((None if k % 23 == 0 else "" if k % 29 == 0 else text, lang, source))
    docs += [("only once here", "lone", "a"), ("", "lone", "b"), (None, "lone", None), ("solo", "single", "a")] + docs[:9]
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "n") for d in docs], "text string, lang string, source string, rank int, Term string")


@pytest.mark.parametrize("shard, block, held", [(1 << 16, 1 << 20, 1 << 18), (7, 16, 10)])
def test_equals_brute_force(spark, monkeypatch, shard, block, held):
    monkeypatch.setattr(divergence, "SHARD", shard)
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "HELD", held)
    docs = made()
    got = divergences(frame(spark, docs).repartition(5)).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(map(tuple, got.collect())) == brute(docs)


def test_small_splits_count_the_same(spark, monkeypatch):
    docs = made(60, 4)
    monkeypatch.setattr(divergence, "SPLIT", 40)
    got = divergences(frame(spark, docs)).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(map(tuple, got.collect())) == brute(docs)


def test_top_ranks_only(spark):
    docs = [(f"w{chr(97 + i % 26)}{chr(97 + i // 26)} " * (1 + i % 7), "en", "a") for i in range(300)] * 3 + [("q " * 4000, "en", "b")] * 3
    got = divergences(frame(spark, docs)).select("lang", "source", "part", "item", "value", "rank")
    got = sorted(map(tuple, got.collect()))
    assert got == brute(docs) and max(r[-1] for r in got) == 200


def test_shares_are_exact_past_64_bits():
    count, total = [0, 1, 9 * 10**15 - 2, 123456789012345], 9 * 10**15
    assert shares(np.array(count), np.int64(total)).tolist() == [1 + 10**9 * (c + 1) // total for c in count]


def test_empty_table(spark):
    assert divergences(frame(spark, made(5)).limit(0)).count() == 0
