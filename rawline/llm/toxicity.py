"""Toxicity by a weighted finite-state pattern grammar.

A clause is read as a string of symbols: I insult, H threat, T target (a
person spoken of), N negation, R reported speech, O any other word, '|' the
clause's end. Small transducers mark an insult or threat that a negation
precedes closely and one that is reported; their composition is one
deterministic transducer, and a last one pairs the marked words of a clause
with a target in it. What a text scores comes from its matched clauses: the
weights of the words that each output symbol let through. The weights of the
insult words (and word beginnings) and of the output symbols are learned from
labelled rows; the closed word classes are given.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import free_names, ready, settle

# Closed word classes (English, German, French, Spanish): fixed values.
THREAT = frozenset("kill hurt beat stab shoot burn destroy murder töten schlagen erschießen tuer frapper brûler matar pegar golpear quemar".split())
TARGET = frozenset("you your yours he she they them him people du dich dir ihr euch sie tu toi te vous ils elles tú ti usted ustedes ellos ellas".split())
NEGATION = frozenset("not no never nobody nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún".split())
REPORTED = frozenset("said says say told called quoted wrote reported sagte sagt schrieb nannte dit disait écrit appelé dijo dice llamó escribió".split())

TOKEN = re.compile(r"[^\W\d_]+|[.,;:!?\n]")
WORDS = re.compile(r"[^\W\d_]+")
#: Word beginnings that may be learned beside whole words.
STEMS = (4, 5, 6)
#: A negation reaches this many words on.
REACH = 3
#: Most labelled rows that a fit reads, and most learned terms.
MAX_ROWS = 40_000
MAX_TERMS = 50_000
#: A term needs this much evidence (nats against its base rate) beyond the log of
#: the number of terms tried, so that of all of them under one in ten passes by
#: chance, whatever the number of labels; this share of its documents labelled 1;
#: and these log-odds (smoothed).
SURE, PURITY, ODDS = 2.3, 0.9, 4.0
CLASSES = ("I", "In", "Ir", "Inr", "H", "Hn", "Hr", "Hnr")
#: How a text's clauses are summed up: a constant; largest and sum per class, with
#: and without a target; largest and sum over all classes, which carry a class that
#: the labelled rows never show.
FEATURES = 4 * len(CLASSES) + 3


class Transducer:
    """Deterministic: (state, symbol) -> (state, symbol). State 0 starts."""

    def __init__(self, arcs: dict[tuple[int, str], tuple[int, str]], states: int):
        self.arcs, self.states = arcs, states

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol), (state, symbol))

    def then(self, other: Transducer, symbols: list[str]) -> Transducer:
        """Composition: what this one writes, the other one reads."""
        arcs = {}
        for a in range(self.states):
            for b in range(other.states):
                for s in symbols:
                    a2, mid = self.step(a, s)
                    b2, out = other.step(b, mid)
                    arcs[a * other.states + b, s] = (a2 * other.states + b2, out)
        return Transducer(arcs, self.states * other.states)


def grammar() -> Transducer:
    """Negation, then reported speech, over the clause symbols."""
    symbols = ["I", "H", "T", "N", "R", "O", "|"]
    negation = {}
    for k in range(REACH + 1):
        for s in symbols:
            negation[k, s] = (max(0, k - 1), s + "n" if k and s in "IH" else s)
        negation[k, "N"] = (REACH, "N")
        negation[k, "|"] = (0, "|")
    report = {}
    for s in ("I", "H", "In", "Hn"):
        report[1, s] = (1, s + "r")
    for k in (0, 1):
        report[k, "R"] = (1, "R")
        report[k, "|"] = (0, "|")
    return Transducer(negation, REACH + 1).then(Transducer(report, 2), symbols)


@dataclass
class ToxicModel:
    """Learned terms (a term with '*' is a word beginning), symbol weights."""

    terms: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.concatenate(([-4.0], np.zeros(FEATURES - 1))))

    def insult(self, word: str) -> float:
        """Weight of the longest term that fits a word; 0 if none does."""
        w = self.terms.get(word)
        if w is None:
            for n in reversed(STEMS):
                if len(word) >= n and (w := self.terms.get(word[:n] + "*")) is not None:
                    return w
        return w or 0.0


def clause_features(text: str, model: ToxicModel, machine: Transducer, seen: dict[str, float]) -> np.ndarray:
    """Features of a whole text; ``seen`` remembers the words' weights."""
    out = np.zeros(FEATURES)
    out[0] = 1.0
    low = text.lower()
    marked = False
    for w in set(WORDS.findall(low)):
        if (v := seen.get(w)) is None:
            v = seen[w] = model.insult(w)
        marked = marked or v > 0 or w in THREAT
    if not marked:  # no clause can match
        return out
    k = len(CLASSES)
    largest, total = np.zeros((2, k)), np.zeros((2, k))
    state, clause, targeted = 0, np.zeros(k), 0
    for token in TOKEN.findall(low + "\n"):
        weight = 0.0
        if token in ".,;:!?\n":
            symbol = "|"
        elif (weight := seen.get(token) or 0.0) > 0:
            symbol = "I"
        elif token in THREAT:
            symbol, weight = "H", 1.0
        else:
            symbol = "T" if token in TARGET else "N" if token in NEGATION else "R" if token in REPORTED else "O"
        state, written = machine.step(state, symbol)
        if weight:
            clause[CLASSES.index(written)] += weight
        targeted |= symbol == "T"
        if symbol == "|":
            if clause.any():
                largest[targeted] = np.maximum(largest[targeted], clause)
                total[targeted] += clause
                clause = np.zeros(k)
            targeted = 0
    out[1:-2] = np.concatenate((largest.ravel() / 4, np.log1p(total).ravel() / 4))
    out[-2:] = largest.max() / 4, np.log1p(total.sum()) / 4
    return out


def learn_terms(labelled: DataFrame) -> dict[str, float]:
    """Words and word beginnings that label 1 goes with, by document counts,
    each judged by itself: one that only stands beside others is kept too.
    ``labelled``: text, toxic (0 or 1). Batches are counted where they are."""
    ready(labelled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = (Counter(), Counter())
            for text, y in zip(b["text"].to_pylist(), b["toxic"].to_pylist()):
                words = set(WORDS.findall((text or "").lower()))
                counts[1 if y else 0].update(words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n})
            terms = [t for t in counts[0] if t not in counts[1]] + list(counts[1])
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())], ["term", "pos", "neg"])

    sides = labelled.groupBy("toxic").count().collect()  # two rows
    n_pos = sum(r["count"] for r in sides if r["toxic"] == 1)
    n_neg = sum(r["count"] for r in sides if r["toxic"] == 0)
    if not n_pos or not n_neg:
        return {}
    base = n_pos / (n_pos + n_neg)
    counted = labelled.select("text", "toxic").mapInArrow(run, "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counted = settle(counted, "toxic-terms")
    tried = counted.count()
    p = F.col("pos") / (F.col("pos") + F.col("neg"))
    gain = F.col("pos") * F.log(p / base) + F.col("neg") * F.coalesce(F.log((1 - p) / (1 - base)), F.lit(0.0))
    found = counted.filter((p > base) & (p >= PURITY)).withColumn("gain", gain).filter(F.col("gain") >= math.log(max(1, tried)) + SURE)
    rows = found.orderBy(F.desc("gain"), "term").limit(MAX_TERMS).collect()
    weights = {r["term"]: math.log((r["pos"] + 0.5) / (n_pos + 1)) - math.log((r["neg"] + 0.5) / (n_neg + 1)) for r in rows}
    return {t: min(6.0, v) for t, v in weights.items() if v >= ODDS}


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> ToxicModel:
    """Fit on the documents (doc_id, text) that ``labels`` (doc_id, toxic)
    marks outside the held-out fold, at most ``max_rows`` labels, the first by
    a hash of doc_id (the larger label, if one doc_id has both). Null labels
    are left out; without both labels the model scores every text alike (low)."""
    ids = labels.filter("toxic in (0, 1)").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids = settle(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).withColumnRenamed("doc_id", "of"), "toxic-ids")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("of"))  # at most max_rows ids
    rows = settle(rows.select("doc_id", "text", "toxic"), "toxic-rows")
    # copies of a text count once
    lead = rows.groupBy(F.xxhash64("text").alias("t"), "toxic").agg(F.min("doc_id").alias("of")).select("of").distinct()
    rows = rows.join(F.broadcast(lead), F.col("doc_id") == F.col("of")).select("doc_id", "text", "toxic")
    rows = rows.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    model = ToxicModel(learn_terms(rows))
    if not model.terms:
        return model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, seen = grammar(), {}
        for b in batches:
            x = [clause_features(t or "", model, machine, seen) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["toxic"], pa.array([v.tolist() for v in x], pa.list_(pa.float64()))], ["toxic", "x"])

    # equal feature rows are counted, so that what reaches the driver is small
    got = rows.select("text", "toxic").mapInArrow(run, "toxic int, x array<double>").groupBy("toxic", "x").count().collect()
    x = np.array([r["x"] for r in got])
    y = np.array([r["toxic"] for r in got], float)
    c = np.array([r["count"] for r in got], float)
    w = np.zeros(FEATURES)
    ridge = np.full(FEATURES, 0.5)
    ridge[0] = 1e-3
    ridge[-2:] = 0.02  # classes differ from what they share only as far as the rows show it
    for _ in range(50):  # Newton steps of ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (c * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, x.T @ (c * (y - p)) - ridge * w)
        w = w + step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-6:
            break
    model.weights = w
    return model


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """``docs`` (doc_id, text and any others) with score (0 to 1), named with
    underscores in front if ``docs`` has a column score.

    A null, empty or blank text has no clauses and gets the score of a text
    without matches. Repeated rows score alike. An empty table gives an empty
    result. Only text is read; the other columns are carried through.
    """
    spark = docs.sparkSession
    ready(spark)
    held = spark.sparkContext.broadcast(model)  # at most MAX_TERMS terms
    name = free_names(["score"], docs.columns)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, machine, seen = held.value, grammar(), {}
        for b in batches:
            if len(seen) > 2_000_000:
                seen = {}
            z = [float(clause_features(t.as_py() or "", m, machine, seen) @ m.weights) for t in b["text"]]
            s = [1 / (1 + math.exp(-max(-30.0, min(30.0, v)))) for v in z]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def accept(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with their
    columns, whatever these are named."""
    model = fit(docs, labels)
    scored = score(docs, model)
    return scored.filter(F.col(scored.columns[-1]) < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
