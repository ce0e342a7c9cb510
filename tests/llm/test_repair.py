import random

import pytest
from brute_repair import brute, repaired

from rawline.llm.repair import AT_END, START, chunk_costs, damage, level, linked_chunks, repair, trace

DDL = "conv_id long, turn long, role string, text string, cost string, Audit int"
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def made(n, seed, rows=8):
    rng = random.Random(seed)
    texts = ["Well.", "Well. \n", "no end", "", " \t", "A? b", "e!", None, "é…", "x" * 3000 + "."]
    out = []
    for conv in range(n):
        size = rng.randint(1, rows)
        turns = rng.sample(range(size + 4), size)
        for turn in sorted(turns):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", None, "", "User"])
            out.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.6 else f"t{rng.random()}."))
    return out


def collected(spark, rows, bits):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL).repartition(3)
    return {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in repair(df, bits=bits).collect()}


@pytest.mark.parametrize("bits, seed", [(8, 1), (1, 2)])
def test_equals_brute_force(spark, bits, seed):
    rows = made(150, seed)
    rows += [(200, None, "user", "null turn."), (200, 3, "user", "later."), (None, 1, "user", "a."), (None, 2, "assistant", "b."), (201, None, None, None)]
    rows += [(202, 5, "user", "same.")] * 7 + [(202, 6, "assistant", "same.")] * 3  # repeated rows
    assert collected(spark, rows, bits) == brute(rows)


def test_long_conversations_over_many_chunks(spark):
    rng = random.Random(4)
    rows = []
    for conv, kinds in ((1, ["user", "assistant"]), (2, ["tool"]), (3, ["user"]), (4, ["assistant", "tool", "system"]), (5, ["user", "assistant", "tool"])):
        rows += [(conv, t, rng.choice(kinds), rng.choice(["ok.", "cut", f"{t}."]) if conv != 5 else "") for t in range(150)]
    assert collected(spark, rows, 2) == brute(rows)


def test_conversation_that_loses_all_rows(spark):
    gone = next(c for c in range(10_000) if not brute([(c, 1, "user", "a.")])[c][5])
    assert collected(spark, [(gone, 1, "user", "a.")], 8) == brute([(gone, 1, "user", "a.")])
    assert collected(spark, [(gone, 1, "user", "a.")], 8)[gone][6] == ""


def test_empty_table(spark):
    assert repair(spark.createDataFrame([], DDL)).count() == 0


def test_chunks_link_up(spark):
    df = spark.createDataFrame([(c, t, "user", f"{c}{t}.") for c in range(5) for t in range(20)], "conv_id long, turn long, role string, text string")
    chunks = linked_chunks(damage(df), 2).collect()
    heads = {(r["conv_id"], r["next"]) for r in chunks if r["next"] is not None}
    assert heads <= {(r["conv_id"], r["chunk"]) for r in chunks}
    assert len(heads) == len(chunks) - 5
    assert max(len(r["rows"]) for r in chunks) <= 4


def test_trace_is_least_on_small_alphabets():
    """Codes by hand against the forward version that carries its audit."""
    rng = random.Random(8)
    for _ in range(500):
        roles = [rng.choice(["system", "user", "assistant", "tool"]) for _ in range(rng.randint(0, 9))]
        cuts = [rng.random() < 0.3 for _ in roles]
        rows = [(t, r, f"{t}" + ("" if c else ".")) for t, (r, c) in enumerate(zip(roles, cuts))]
        codes = ["suat".index(r[0]) + (4 if c else 0) for r, c in zip(roles, cuts)]
        if not codes:
            continue
        _, cost, audit, _ = repaired(rows)
        state, own_cost, own_audit, acts = trace(codes, [0] * len(codes), list(AT_END), START, True)
        assert (own_cost, own_audit, "".join(acts)) == (cost, audit, audit)


def test_vectors_converge():
    rng = random.Random(3)
    codes = [rng.randint(1, 2) for _ in range(30)]
    ends = ([0, 4, 2, 0], [5, 0, 0, 1], [0, 0, 0, 0])
    assert len({tuple(level(chunk_costs(codes, list(e))[0])) for e in ends}) == 1
