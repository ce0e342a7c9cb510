import math
import random
import re

import numpy as np
import pytest
from conftest import rows

from rawline.llm import toxicity as X


def read(text, terms=("grobian", "lout")):
    model = X.ToxicModel({t: 2.0 for t in terms})
    f = X.clause_features(text, model, X.grammar(), {})[1:-2].reshape(2, 2, len(X.CLASSES))
    return {(X.CLASSES[k], bool(t)): float(f[0, t, k]) * 4 for t in (0, 1) for k in range(len(X.CLASSES)) if f[0, t, k]}


@pytest.mark.parametrize(
    "text,want",
    [
        ("What a lout.", {("I", False): 2}),
        ("You are a lout.", {("I", True): 2}),
        ("You there. A lout.", {("I", False): 2}),
        ("He is not a lout.", {("In", True): 2}),
        ("Not that one would ever call a lout", {("I", False): 2}),
        ("She said you lout, lout", {("Ir", True): 2, ("I", False): 2}),
        ("They said: no lout", {("In", False): 2}),
        ("Someone said no lout", {("Inr", False): 2}),
        ("kill them", {("H", True): 1}),
        ("A loutish lout lout", {("I", False): 4}),
        ("", {}),
        ("nothing here", {}),
    ],
)
def test_clauses(text, want):
    assert read(text) == want


def test_composition_is_applying_one_after_the_other():
    rng = random.Random(0)
    symbols = ["I", "H", "T", "N", "R", "O", "|"]
    a = X.Transducer({(0, "N"): (1, "N"), (1, "I"): (0, "In"), (1, "|"): (0, "|")}, 2)
    b = X.Transducer({(0, "R"): (1, "R"), (1, "In"): (1, "Inr"), (1, "|"): (0, "|")}, 2)
    both, s, sa, sb = a.then(b, symbols), 0, 0, 0
    for _ in range(500):
        c = rng.choice(symbols)
        s, got = both.step(s, c)
        sa, mid = a.step(sa, c)
        sb, want = b.step(sb, mid)
        assert got == want


def test_word_beginnings():
    m = X.ToxicModel({"gro*": 9.0, "grob*": 1.0, "grobian": 3.0})
    assert [m.insult(w) for w in ("grobian", "grobheit", "gros", "x")] == [3.0, 1.0, 0.0, 0.0]


def corpus(n=600):
    rng = random.Random(5)
    docs, labels = [], []
    words = [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(26) for b in range(12)]
    for i in range(n):
        text = [rng.choice(words) for _ in range(60)]
        toxic = i % 8 == 0
        if toxic:
            text[rng.randrange(60)] = rng.choice(["lout", "churl", "knave"])
        docs.append((i, " ".join(text) + ".", 0.5))
        labels.append((i, int(toxic)))
    return docs + [(n, None, 0.0), (n + 1, "", 0.0), (None, "you knave", 0.0), (n + 2, "you knave", 0.0), (n + 2, "you knave", 0.0)], labels


def test_held_out_rows(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, other double")
    lab = spark.createDataFrame([*labels, (7, None), (None, 1)], "doc_id long, toxic int")
    model = X.fit(d, lab)
    got = {(r["doc_id"], r["text"]): r["score"] for r in X.score(d, model).collect()}
    truth = dict(labels)
    assert all((s >= 0.3) == bool(truth[i]) for (i, _), s in got.items() if i is not None and i < 600)
    assert got[602, "you knave"] >= 0.3 and got[None, "you knave"] >= 0.3
    assert got[600, None] == got[601, ""] < 0.3
    kept = X.accept(d, lab)
    assert kept.columns == d.columns
    assert {r[0] for r in rows(kept, "doc_id")} == {i for i, t in labels if not t} | {600, 601}


def test_nothing_to_learn_from(spark):
    d = spark.createDataFrame([(1, "a lout")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] < 0.3 for r in X.score(d, X.fit(d, none)).collect()] == [True]
    assert X.score(d.limit(0), X.fit(d, none)).count() == 0


def test_clashing_score_column(spark):
    from rawline.llm import toxicity

    docs = spark.createDataFrame([(i, "you are a moron" if i % 2 else "a fine day", "mine") for i in range(40)], "doc_id long, text string, SCORE string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    kept = toxicity.accept(docs, labels)
    assert kept.columns == docs.columns and {r["SCORE"] for r in kept.collect()} <= {"mine"}
    assert toxicity.score(docs, toxicity.ToxicModel()).columns == [*docs.columns, "_score"]


def test_a_term_beside_stronger_ones_is_kept(spark):
    """Each term is judged by itself; the evidence asked for follows the number
    of terms tried, not the number of labels."""
    rng = random.Random(9)
    plain = [f"{a}{b}" for a in "bcdfgklmnp" for b in ("ana", "ebe", "idi", "olo")]
    rows_ = []
    for i in range(400):
        text = rng.sample(plain, 12)
        if i % 8 == 0:
            text.append("grobian")
            if i % 16 == 0:
                text.append("lout")  # never without the stronger term
        rows_.append((" ".join(text), int(i % 8 == 0)))
    terms = X.learn_terms(spark.createDataFrame(rows_, "text string, toxic int"))
    assert {"grobian", "lout"} <= terms.keys() and not terms.keys() & set(plain)
    few = X.learn_terms(spark.createDataFrame(rows_[:120], "text string, toxic int"))
    assert "grobian" in few


def brute_score(text, terms, weights):
    """Clause by clause, without transducers: negation and report by looking back."""
    feats = [[0.0] * 8 for _ in range(4)]  # largest without/with target, sum without/with
    for clause in re.split(r"[.,;:!?\n]", text.lower()):
        words = re.findall(r"[^\W\d_]+", clause)
        got = [0.0] * 8
        for i, w in enumerate(words):
            fit = terms.get(w) or next((terms[w[:n] + "*"] for n in (6, 5, 4) if len(w) >= n and w[:n] + "*" in terms), 0.0)
            if fit or w in X.THREAT:
                negated = any(v in X.NEGATION and not known(v, terms) and v not in X.THREAT and v not in X.TARGET for v in words[max(0, i - X.REACH) : i])
                reported = any(v in X.REPORTED and not known(v, terms) for v in words[:i])
                got[(0 if fit else 4) + negated + 2 * reported] += fit or 1.0
        side = any(w in X.TARGET and not known(w, terms) for w in words)
        feats[side] = [max(a, b) for a, b in zip(feats[side], got)]
        feats[2 + side] = [a + b for a, b in zip(feats[2 + side], got)]
    x = [1.0, *(v / 4 for r in feats[:2] for v in r), *(math.log1p(v) / 4 for r in feats[2:] for v in r)]
    x += [max(map(max, feats[:2])) / 4, math.log1p(sum(map(sum, feats[2:]))) / 4]
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(x, weights))))))


def known(word, terms):
    return word in terms or any(len(word) >= n and word[:n] + "*" in terms for n in (4, 5, 6))


def test_scores_equal_brute_force(spark):
    rng = random.Random(11)
    terms = {"lout": 2.0, "churl": 3.5, "grob*": 1.25, "knaves*": 2.5}
    words = ["lout", "churl", "grobian", "knavesque", "kill", "you", "them", "not", "nie", "said", "quoted", "tree", "day", ".", ",", "!", "\n", "3", "Lout"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(400)]
    model = X.ToxicModel(terms, np.array([rng.uniform(-2, 2) for _ in range(X.FEATURES)]))
    got = {r["doc_id"]: r["score"] for r in X.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(brute_score(t, terms, model.weights), abs=1e-12), t
