"""How far the sources of a language diverge, term by term and in pairs.

Arrow kernels inside ``mapInArrow`` lower-case, split, encode and count the
terms of every text; tasks hand on partial counts. Spark merges them by
(lang, term) and writes them as shards of terms (one column a count); numpy
adds up the divergences of each shard, Spark those of all shards.

With counts c of V kept terms that sum to N, a group gives a term
p = 1 + floor(SCALE * (c + 1) / (N + V)); the divergence of p from q at a term
is floor((p - q)^2 / q). All of it is integer arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, settle

#: What ends a term: every ASCII character that is no letter.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
#: Documents of a language that a kept term occurs in.
LEAST_DOCS = 3
#: Ranks of the term part.
TOP = 200
#: Rows (of term and source) of one shard, and numbers of one block of a shard.
SHARD = 1 << 16
BLOCK = 1 << 20
#: Texts (bytes) that are split at once, and counted terms that a task holds.
SPLIT = 1 << 22
HELD = 1 << 18

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def terms_of(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Partial counts (lang, source, term, n, docs) of some whole texts."""
    parts = pc.split_pattern_regex(pc.ascii_lower(text), BETWEEN)
    row, term = pc.list_parent_indices(parts), pc.list_flatten(parts)
    some = pc.greater(pc.binary_length(term), 0)
    row, term = row.filter(some), term.filter(some).dictionary_encode()
    t = pa.table({"row": row, "code": term.indices})
    in_text = t.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    groups = pa.table({"lang": lang, "source": source, "g": pa.array(np.arange(len(lang)))})
    # a group is named by its first row, so that only integers are grouped below
    first = groups.group_by(["lang", "source"], use_threads=False).aggregate([("g", "min"), ("g", "list")])
    name = np.empty(len(lang), np.int64)
    name[pc.list_flatten(first["g_list"].combine_chunks()).to_numpy()] = np.repeat(
        first["g_min"].to_numpy(), pc.list_value_length(first["g_list"].combine_chunks()).to_numpy()
    )
    t = pa.table({"g": name[in_text["row"].to_numpy()], "code": in_text["code"], "n": in_text["count_all"]})
    t = t.group_by(["g", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    return pa.table(
        [lang.take(t["g"].combine_chunks()), source.take(t["g"].combine_chunks()), term.dictionary.take(t["code"].combine_chunks()), t["n_sum"], t["n_count"]],
        schema=COUNTS,
    )


def merged(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return t.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(COUNTS.names)


def partial_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), each task's counts: bounded memory, as a
    task hands its counts on when it holds many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = fresh = 0
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff(size // SPLIT, prepend=0)).tolist()
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a < b:
                    held.append(terms_of(batch["lang"].slice(a, b - a), batch["source"].slice(a, b - a), batch["text"].slice(a, b - a)))
                    fresh += held[-1].num_rows
            if fresh > HELD:
                held, fresh = [merged(held)], 0
                rows = held[0].num_rows
                if rows > HELD:
                    yield from held[0].to_batches()
                    held = []
        if held:
            yield from merged(held).to_batches()

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def shares(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total) for counts up to 9e15: long
    division in digits of 1000, as the product itself may pass 64 bits."""
    rest, out = count + 1, np.zeros(np.broadcast(count, total).shape, np.int64)
    whole, rest = rest // total, rest % total
    out += whole
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def shard_divergences(counts: pa.Table, groups: pa.Table) -> pa.Table:
    """(source, part, item, value) of one shard: for ``pair`` the sums over its
    terms, for ``term`` the best TOP of each source.

    counts: source, term, n, lang_n, of every term of the shard; groups: all
    sources of the language with their sum ``total``, and the language's kept
    terms ``kept`` and their sum ``lang_total``.
    """
    names = groups["source"].combine_chunks()
    many = len(names)
    kept, lang_total = groups["kept"][0].as_py(), groups["lang_total"][0].as_py()
    sums = np.zeros((many, many), np.int64)
    out = []
    if counts.num_rows:
        over = groups["total"].to_numpy() + kept
        words = counts["term"].combine_chunks().dictionary_encode()
        term = words.indices.to_numpy()
        src = pc.index_in(counts["source"].combine_chunks(), names).to_numpy()
        n, lang_n = counts["n"].to_numpy(), counts["lang_n"].to_numpy()
        p, q = shares(n, over[src]), shares(lang_n, np.int64(lang_total + kept))
        up = np.flatnonzero(p > q)
        best = pa.table({"source": names.take(pa.array(src[up])), "item": words.dictionary.take(pa.array(term[up])), "value": gap(p[up], q[up])})
        best = best.sort_by([("source", "ascending"), ("value", "descending"), ("item", "ascending")])
        code = best["source"].combine_chunks().dictionary_encode().indices.to_numpy()
        rank = np.arange(len(code)) - np.searchsorted(code, code)  # sources are numbered as they come
        best = best.filter(pa.array(rank < TOP))
        out.append((best["source"], "term", best["item"], best["value"]))

        none = shares(np.zeros(many, np.int64), over)  # of a term that the source lacks
        n_terms = len(words.dictionary)
        # every term as if the row's source lacked it, by how often counts occur in the column's
        for h in range(many):
            mine = n[src == h]
            c, often = np.unique(mine, return_counts=True)
            c, often = np.append(c, 0), np.append(often, n_terms - len(mine))
            sums[:, h] += gap(none[:, None], shares(c, over[h])[None, :]) @ often
        # then what changes at the terms that it has
        order = np.argsort(term, kind="stable")
        step = max(1, BLOCK // many)
        ends = np.searchsorted(term[order], np.arange(0, n_terms + step, step))
        for a, b, first in zip(ends, ends[1:], range(0, n_terms, step)):
            rows = order[a:b]
            table = np.zeros((min(step, n_terms - first), many), np.int64)
            table[term[rows] - first, src[rows]] = n[rows]
            table = shares(table, over[None, :])
            for g in np.unique(src[rows]):
                has = rows[src[rows] == g]
                theirs = table[term[has] - first]
                sums[g] += (gap(p[has][:, None], theirs) - gap(none[g], theirs)).sum(axis=0)
    a, b = np.nonzero(~np.eye(many, dtype=bool))
    out.append((names.take(pa.array(a)), "pair", names.take(pa.array(b)), pa.array(sums[a, b])))
    return pa.concat_tables(
        pa.table({"source": s, "part": pa.array([part] * len(s), pa.string()), "item": i, "value": v}) for s, part, i, v in out
    )


def divergences(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (text, lang,
    source): part ``pair`` compares a source with each other source of its
    language over all kept terms; part ``term`` names the TOP terms that it
    has more often than its language, by their divergence.

    Null text, lang or source counts as ''. Empty and repeated rows are
    documents of their own. A group without terms is compared all the same; a
    language that keeps no term gives pairs of value 0; a lone source has no
    pair. Equal values are ranked by item (UTF-8). An empty table gives an
    empty result; other columns are not read.
    """
    ready(docs.sparkSession)
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    term = Window.partitionBy("lang", "term")
    counts = (
        partial_counts(docs)
        .repartition(F.col("lang"), F.col("term"))  # the sums below need no shuffle of their own
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumns({"in_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term)})
        .filter(F.col("in_docs") >= LEAST_DOCS)
        .withColumn("leads", (F.row_number().over(term.orderBy("source")) == 1).cast("long"))
    )
    counts = settle(counts.select("lang", "source", "term", "n", "lang_n", "leads"), "term_counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("leads").alias("leads"), F.count(F.lit(1)).alias("rows"))
    of_lang = totals.groupBy("lang").agg(
        F.sum("leads").alias("kept"), F.sum("total").alias("lang_total"), F.ceil(F.sum("rows") / SHARD).alias("shards")
    )
    groups = (
        docs.select("lang", "source").distinct()
        .join(totals.select("lang", "source", "total"), ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .na.fill(0, ["total", "kept", "lang_total"]).na.fill(1, ["shards"])
    )
    groups = settle(groups, "source_groups")
    width = groups.groupBy("lang").agg(F.max("shards").alias("shards"))
    left = counts.drop("leads").join(width, "lang").withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")).cast("long"))
    right = groups.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))

    def run(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        t = shard_divergences(a, b)
        return t.add_column(0, "lang", pa.array([key[0].as_py()] * t.num_rows, pa.string()))

    found = left.groupBy("lang", "shard").cogroup(right.groupBy("lang", "shard")).applyInArrow(
        run, "lang string, source string, part string, item string, value long"
    )
    # a term stands in one shard, so only pairs are added up
    found = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranks = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = found.withColumn("rank", F.row_number().over(ranks).cast("int"))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= TOP))
