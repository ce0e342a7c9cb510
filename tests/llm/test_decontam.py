import random
import re
from collections import Counter

import pytest
from conftest import rows

from rawline.llm.decontam import BLOCKS, RADIUS, VARY, clean, contaminated

DOCS, ITEMS = "doc_id long, text string, len int, sh string", "item_id long, text string, k int"


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def grams(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def best(doc, item):
    d, i = words(doc), words(item)
    if not d or not i:
        return 0.0
    k = min(5, len(i))
    out = 0.0
    for s in range(max(1, len(d) - len(i) + 1)):
        a, b = grams(d[s : s + len(i)], k), grams(i, k)
        out = max(out, sum((a & b).values()) / max(1, sum((a | b).values())))
    return out


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS), spark.createDataFrame([(*i, 2) for i in items], ITEMS)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_equals_brute_force(spark):
    rng = random.Random(1)
    items = [(i, sentence(rng, n)) for i, n in enumerate([3, 5, 8, 20, 20, 40, 60])]
    items += [(90, items[4][1].upper()), (91, None), (92, "?!"), (93, "")]
    docs = []
    for i, t in items[:7]:
        w = t.split()
        docs.append(sentence(rng, 30) + "\n" + t.title() + "! " + sentence(rng, 10))
        docs.append(t)
        if len(w) >= 20:
            near = list(w)
            near[3] = "changed"
            docs.append(sentence(rng, 7) + " " + ", ".join(near) + " " + sentence(rng, 7))
            docs.append(sentence(rng, 7) + " " + " ".join(w[: len(w) // 2]) + " " + sentence(rng, 7))
            docs.append(" ".join(w[1:]))
            docs.append(sentence(rng, 9) + " " + " ".join([*w[:6], "extra", *w[6:]]) + " " + sentence(rng, 3))
    docs = list(enumerate(docs)) + [(500, None), (501, ""), (502, sentence(rng, 100)), (503, "a"), (None, items[3][1]), (1, docs[1]), (1, docs[1])]
    d, i = frames(spark, docs, items)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in contaminated(d, i).collect()}
    want = {}
    for doc, text in docs:
        for item, t in items[:7]:
            s = best(text, t)
            if s >= 0.8:
                want[doc, item] = max(s, want.get((doc, item), 0.0))
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    kept = clean(d, i)
    assert kept.columns == d.columns
    assert {r[0] for r in rows(kept, "doc_id")} == {doc for doc, _ in docs} - {doc for doc, _ in want}


def test_reordered_items(spark):
    rng = random.Random(4)
    items = [(i, sentence(rng, n)) for i, n in enumerate([50, 100, 100, 200])]
    docs = []
    for i, t in items:
        w = t.split()
        for moved in (w[len(w) // 2 :] + w[: len(w) // 2], w[-len(w) // 6 :] + w[: -len(w) // 6], w[: len(w) // 3] + w[len(w) // 2 :] + w[len(w) // 3 : len(w) // 2]):
            docs += [" ".join(moved), sentence(rng, 13) + " " + " ".join(moved) + " " + sentence(rng, 13)]
    docs = list(enumerate(docs))
    d, i = frames(spark, docs, items)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in contaminated(d, i).collect()}
    want = {(doc, item): s for doc, text in docs for item, t in items if (s := best(text, t)) >= 0.8}
    # the fingerprint's radius may miss a pair right at the threshold, never one of 0.83 or more here
    assert len(want) >= 20 and {k for k, s in want.items() if s >= 0.83} <= got.keys() <= want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in got)


@pytest.mark.parametrize("empty", ["docs", "items"])
def test_empty(spark, empty):
    d, i = frames(spark, [(1, "a b c d e f")], [(1, "a b c d e f")])
    d, i = (d.limit(0), i) if empty == "docs" else (d, i.limit(0))
    assert contaminated(d, i).count() == 0
    assert clean(d, i).count() == d.count()


def test_blocks_guarantee_the_radius():
    # RADIUS + 1 differing bits can spread VARY + 1 over every block; RADIUS cannot
    assert RADIUS == BLOCKS * (VARY + 1) - 1


def test_no_python_in_the_plan(spark):
    d, i = frames(spark, [(1, "a b c d e f")], [(1, "a b c d e f")])
    plan = contaminated(d, i)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
