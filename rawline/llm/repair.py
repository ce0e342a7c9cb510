"""Conversations brought back to alternating turns at the least cost.

Roles must read ``(s?(ua)+)?`` by their initials. Rows may be kept, rerolled,
deleted, and empty turns inserted. The cheapest edits come from a Viterbi
search over four states (nothing yet, after s, u, a), run backwards from the
conversation's end, in parallel over chunks of its rows:

* every chunk starts from a speculative vector of costs (the true one at the
  conversation's end) and gives the vector before its first row;
* fix-up passes run those chunks again whose successor now gives a vector that
  differs from the assumed one by more than a constant, until there is none
  (a constant changes no choice);
* backward costs of the stitched chunks then drive the trace, which takes the
  edit whose initial is least among the cheapest. The state in which a chunk
  is entered comes from the chunks before it by pointer doubling.

Rows that must go (blank, repeated) do not change the state, so they are left
out of the vectors and added to cost and audit only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, settle

#: Rows of a chunk: 2 to this power.
CHUNK_BITS = 8
#: Texts of which a task remembers that it has handed them on.
SEEN = 1 << 17
BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, after s, after u, after a.
START, S, U, A = range(4)
#: By state: where an inserted or rerolled turn leads, and its role.
TO = (U, U, A, U)
MADE = ("user", "user", "assistant", "user")
#: By class of a row's initial (s, u, a, other): the state after keeping it, None if it may not be kept.
KEEP = ((S, None, None, None), (U, U, None, U), (None, None, A, None), (None,) * 4)
#: Costs of the turns that a conversation still lacks at its end, by state.
AT_END = (0, 4, 2, 0)
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: Class codes of rows: 0 to 3 as in KEEP, CUT added if truncated, FORCED if the row must go.
CUT, FORCED = 4, 8
LEGAL = ("su", "ua", "au")


def damage(rows: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Rows (conv_id, turn, role, text) with planted faults, by crc32 of
    ``conv_id:turn`` (null: one space) modulo 20: 0 drops the row, 1 empties
    its text, 2 takes out ``.!?``, 3 repeats it, 4 makes it the user's. Null
    role and text become one space."""
    own = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    fault = F.crc32(F.concat_ws(":", own[0], own[1])) % 20 if bucket is None else bucket
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(own[3], "[.!?]", "")).otherwise(own[3])
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(own[2]).alias("role"), text.alias("text"),
        F.when(fault == 3, 2).otherwise(1).cast("long").alias("copies"), fault.alias("fault"),
    ).filter(F.col("fault") != 0).drop("fault")


def before(code: int, after: list[int]) -> list[int]:
    """Costs before a row that need not go, from those after it."""
    extra = TRUNCATED if code & CUT else 0
    kept = KEEP[code & 3]
    own = []
    for s in range(4):
        c = min(DELETE + after[s], REROLE + extra + after[TO[s]])
        k = kept[s]
        own.append(c if k is None else min(c, extra + after[k]))
    u, a = own[U], own[A]  # inserting leads to one of these two
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return [min(own[START], INSERT + u), min(own[S], INSERT + u), u, a]


def level(costs: list[int]) -> list[int]:
    """Costs up to a constant."""
    least = min(costs)
    return [c - least for c in costs]


def chunk_costs(codes: list[int], end: list[int]) -> list[list[int]]:
    """Vectors before each row of a chunk (up to a constant each) and, last, at its end."""
    out = [list(end)]
    for code in reversed(codes):
        out.append(out[-1] if code & FORCED else level(before(code, out[-1])))
    out.reverse()
    return out


def step(code: int, state: int, at: list[int], after: list[int]) -> str:
    """The least initial among the cheapest edits; ``at`` and ``after`` are costs up to one constant."""
    extra = TRUNCATED if code & CUT else 0
    kept = KEEP[code & 3][state]
    if at[state] == DELETE + after[state]:
        return "D"
    if at[state] == INSERT + at[TO[state]]:
        return "I"
    if kept is not None and at[state] == extra + after[kept]:
        return "K"
    return "R"


def trace(codes: list[int], more: list[int], end: list[int], state: int, last: bool) -> tuple[int, int, str, list[str]]:
    """(state after, cost, audit, acts) of a chunk entered in ``state``. An act
    is the initials of the inserted turns before a row and of the row's edit,
    at a conversation's last row also of the turns inserted after it."""
    costs = chunk_costs(codes, end)
    audit, acts, cost = [], [], 0
    for i, code in enumerate(codes):
        act = ""
        if code & FORCED:
            act = "D"
            cost += DELETE
        else:
            after = costs[i + 1]
            at = before(code, after)
            while not act or act[-1] == "I":
                edit = step(code, state, at, after)
                act += edit
                if edit == "D":
                    cost += DELETE
                    continue
                cost += (TRUNCATED if code & CUT and edit != "I" else 0) + {"I": INSERT, "K": 0, "R": REROLE}[edit]
                state = KEEP[code & 3][state] if edit == "K" else TO[state]
        audit.append(act + "D" * more[i])
        cost += DELETE * more[i]
        acts.append(act)
    if last:
        while AT_END[state]:
            state, cost = TO[state], cost + INSERT
            audit.append("I")
            acts[-1] += "I"
    return state, cost, "".join(audit), acts


def lines_of(role: str, act: str, text: str, state: int) -> tuple[list[str], int]:
    """The repaired lines that an act makes of a row, and the state after them."""
    out = []
    for edit in act:
        if edit == "K":
            out.append(f"{role}:{text}")
            state = KEEP["sua".index(role[0])][state]
        elif edit in "IR":
            out.append(f"{MADE[state]}:{text if edit == 'R' else ''}")
            state = TO[state]
    return out, state


def _identity() -> list[Column]:
    """Two hashes of 64 bits that stand for role and text."""
    return [F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "role").alias("k2")]


def _same(a: str, b: str, *cols: str) -> Column:
    """Equal in ``cols``, nulls matched."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return cond


def linked_chunks(rows: DataFrame, bits: int) -> DataFrame:
    """(conv_id, chunk, next, rows, blank, duplicate, truncated, illegal):
    chunks of at most 2^bits rows in order of turn (nulls first), each with
    the number of its conversation's next one."""
    end = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    slim = rows.select(
        "conv_id", "turn", "role", *_identity(), "copies", initial.alias("initial"), code.alias("code"),
        (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    # copies of a row are one row with a count from here on
    slim = slim.groupBy("conv_id", "turn", "role", "k1", "k2", "initial", "code", "blank", "cut").agg(F.sum("copies").alias("copies"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "k1", "k2"]
    slim = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    slim = settle(slim.withColumn("at", F.monotonically_increasing_id()), "turns_in_order")

    seen = slim.filter(~F.col("blank")).groupBy("conv_id", "role", "k1", "k2").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("times"))
    repeated = seen.filter(F.col("times") > 1)
    marked = slim.alias("a").join(repeated.alias("b"), _same("a", "b", "conv_id", "role", "k1", "k2"), "left").select(
        "a.*", F.coalesce(~F.col("blank") & (F.col("first") < F.col("at")), F.lit(False)).alias("again")
    )
    forced, copies = F.col("blank") | F.col("again"), F.col("copies")
    row = F.struct(
        "at", "turn", "role", "k1", "k2", "initial", (copies - 1).alias("more"),
        (F.col("code") + F.when(forced, FORCED).when(F.col("cut"), CUT).otherwise(0)).alias("code"),
    )
    chunks = marked.groupBy("conv_id", F.shiftright("at", bits).alias("chunk")).agg(
        F.sort_array(F.collect_list(row)).alias("rows"),  # at most 2^bits rows
        F.sum(F.when(F.col("blank"), copies).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("again"), copies).otherwise(copies - 1)).alias("duplicate"),
        F.sum((F.col("cut") & ~forced).cast("long")).alias("truncated"),
    )

    def wrong(x: Column, y: Column) -> Column:
        return F.when(F.concat(x, y).isin(*LEGAL), 0).otherwise(1).cast("long")

    zero = F.lit(0).cast("long")
    pairs = F.arrays_zip(F.expr("slice(rows, 1, size(rows) - 1)").alias("x"), F.expr("slice(rows, 2, size(rows))").alias("y"))
    inner = F.aggregate(pairs, zero, lambda n, z: n + wrong(z["x"]["initial"], z["y"]["initial"]))
    twice = F.aggregate("rows", zero, lambda n, z: n + z["more"])  # no initial may follow itself
    chunks = settle(chunks.withColumn("illegal", inner + twice), "turn_chunks")

    # within a partition of the order chunks are numbered on; after its last one comes the next partition with rows
    last = chunks.groupBy(F.shiftright("chunk", 33 - bits).alias("part")).agg(F.max("chunk").alias("last"), F.min("chunk").alias("least"))
    last = last.select("last", F.lead("least").over(Window.orderBy("part")).alias("then"))  # one row a partition
    a = chunks.join(last, F.col("chunk") == F.col("last"), "left").withColumn(
        "n", F.when(F.col("last").isNull(), F.col("chunk") + 1).otherwise(F.col("then"))
    )
    b = chunks.select("conv_id", F.col("chunk").alias("n"), F.col("rows")[0]["initial"].alias("first"))
    over = F.when(F.col("b.n").isNull(), 0).otherwise(wrong(F.element_at("rows", -1)["initial"], F.col("first")))
    linked = a.alias("a").join(b.alias("b"), _same("a", "b", "conv_id", "n"), "left").select(
        "a.conv_id", "chunk", F.col("b.n").alias("next"), "rows", "blank", "duplicate", "truncated", (F.col("illegal") + over).alias("illegal")
    )
    return settle(linked, "linked_chunks")


def backward_costs(many: DataFrame) -> DataFrame:
    """(conv_id, chunk, next, assumed, given): the cost vectors at the end and
    before the first row of each chunk, stitched by fix-up passes."""
    ddl = f"conv_id {many.schema['conv_id'].dataType.simpleString()}, chunk long, next long, assumed array<long>, given array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            given = [level(chunk_costs(c, end)[0]) for c, end in zip(b["codes"].to_pylist(), b["assumed"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b["conv_id"], b["chunk"], b["next"], b["assumed"], pa.array(given, pa.list_(pa.int64()))],
                ["conv_id", "chunk", "next", "assumed", "given"],
            )

    rows = many.select("conv_id", "chunk", "next", F.col("rows.code").alias("codes"))
    guess = F.array(*[F.lit(c).cast("long") for c in AT_END])  # true at a conversation's end, speculative elsewhere
    vectors = settle(rows.withColumn("assumed", guess).mapInArrow(run, ddl), "vectors")

    def level_of(c: str) -> Column:
        return F.transform(c, lambda v: v - F.array_min(c))

    while True:
        found = vectors.select("conv_id", F.col("chunk").alias("next"), F.col("given").alias("after"))
        off = vectors.alias("a").join(found.alias("b"), _same("a", "b", "conv_id", "next")).filter(level_of("assumed") != level_of("after"))
        off = settle(off.select("a.conv_id", "chunk", "after"), "vectors_off")
        if off.isEmpty():
            return vectors
        again = rows.alias("a").join(off.alias("b"), _same("a", "b", "conv_id", "chunk")).select(
            "a.conv_id", "a.chunk", "next", "codes", F.col("after").alias("assumed")
        )
        kept = vectors.alias("a").join(off.alias("b"), _same("a", "b", "conv_id", "chunk"), "left_anti")
        vectors = settle(kept.unionByName(again.mapInArrow(run, ddl)), "vectors")


def entry_states(many: DataFrame, vectors: DataFrame) -> DataFrame:
    """(conv_id, chunk, state): the state in which each chunk is entered, by
    doubling: each round a chunk looks twice as far back, until a chunk that
    is left in one state whatever it was entered in, or the first one."""
    ddl = f"conv_id {many.schema['conv_id'].dataType.simpleString()}, chunk long, next long, way array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ways = [
                [trace(c, [0] * len(c), end, s, False)[0] for s in range(4)]
                for c, end in zip(b["codes"].to_pylist(), b["assumed"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [b["conv_id"], b["chunk"], b["next"], pa.array(ways, pa.list_(pa.int32()))], ["conv_id", "chunk", "next", "way"]
            )

    left = many.filter("next is not null").alias("a").join(vectors.alias("b"), _same("a", "b", "conv_id", "chunk"))
    left = left.select("a.conv_id", "a.chunk", "a.next", F.col("rows.code").alias("codes"), "assumed").mapInArrow(run, ddl)
    left = left.select("conv_id", F.col("chunk").alias("back"), F.col("next").alias("chunk"), "way")
    first = F.array(*[F.lit(START)] * 4)

    def settled(df: DataFrame) -> DataFrame:
        one = F.size(F.array_distinct("way")) == 1
        return settle(df.withColumn("back", F.when(~one, F.col("back"))), "ways")

    ways = many.select("conv_id", "chunk").alias("a").join(left.alias("b"), _same("a", "b", "conv_id", "chunk"), "left")
    ways = settled(ways.select("a.conv_id", "a.chunk", "back", F.coalesce("way", first).alias("way")))
    while not ways.filter("back is not null").isEmpty():
        far = ways.select("conv_id", F.col("chunk").alias("back"), F.col("back").alias("far"), F.col("way").alias("far_way"))
        longer = ways.alias("a").join(far.alias("b"), _same("a", "b", "conv_id", "back"), "left")
        way = F.when(F.col("far_way").isNull(), F.col("way")).otherwise(F.transform("far_way", lambda s: F.get("way", s)))
        ways = settled(longer.select("a.conv_id", "chunk", F.col("far").alias("back"), way.alias("way")))
    return ways.select("conv_id", "chunk", F.col("way")[0].alias("state"))


def traced(chunks: DataFrame) -> DataFrame:
    """``chunks`` with cost, audit and one act a row, by the stitched costs."""
    inner = chunks.filter("next is not null").select("conv_id", F.col("next").alias("chunk"))
    many = chunks.alias("a").join(inner.alias("b"), _same("a", "b", "conv_id", "chunk"), "left")
    many = many.filter(F.col("b.chunk").isNotNull() | F.col("next").isNotNull()).select("a.conv_id", "a.chunk", "next", "rows")
    many = settle(many, "chunks_of_many")
    vectors = backward_costs(many)
    states = entry_states(many, vectors)
    known = vectors.alias("a").join(states.alias("b"), _same("a", "b", "conv_id", "chunk")).select("a.conv_id", "a.chunk", "assumed", "state")
    end = F.array(*[F.lit(c).cast("long") for c in AT_END])
    full = chunks.alias("a").join(known.alias("b"), _same("a", "b", "conv_id", "chunk"), "left").select(
        "a.*", F.coalesce("assumed", end).alias("assumed"), F.coalesce("state", F.lit(START)).alias("state"),
        F.col("rows.code").alias("codes"), F.col("rows.more").alias("more"),
    )
    out = full.drop("assumed", "state", "codes", "more").withColumns(
        {"cost": F.lit(0).cast("long"), "audit": F.lit(""), "acts": F.array(F.lit(""))}
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [
                trace(codes, more, end, state, last is None)
                for codes, more, end, state, last in zip(*(b[c].to_pylist() for c in ("codes", "more", "assumed", "state", "next")))
            ]
            own = [b[c] for c in out.names[:-3]]
            own += [pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*own, pa.array([f[3] for f in found], pa.list_(pa.string()))], out.names)

    return settle(full.mapInArrow(run, out), "traced_chunks")


def repaired_hashes(rows: DataFrame, acts: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the lines of each conversation hashed in
    order as they stream by; rows of ``acts`` name what becomes of a text."""
    key = ["turn", "role", "k1", "k2"]
    kind = rows.schema["conv_id"].dataType.simpleString()

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in batches:
            if len(seen) > SEEN:
                seen = set()
            keys = list(zip(b["c1"].to_pylist(), b["c2"].to_pylist()))
            fresh = [k not in seen and not seen.add(k) for k in keys]
            yield b.filter(pa.array(fresh, pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, act, state, empty = (), None, "", START, True
        done: list[tuple] = []
        for b in batches:
            for c, role, a, text in zip(*(b[n].to_pylist() for n in ("conv_id", "role", "act", "text"))):
                if conv != (c,):
                    if conv:
                        done.append((conv[0], digest.hexdigest()))
                    conv, digest, act, state, empty = (c,), hashlib.sha256(), "", START, True
                if a is not None:
                    act = a
                    continue
                lines, state = lines_of(role, act, text, state)
                act = ""  # further copies of the text add nothing
                for line in lines:
                    digest.update((line if empty else "\n" + line).encode("utf-8", "surrogatepass"))
                    empty = False
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], b.schema.field("conv_id").type), pa.array([d[1] for d in done], pa.string())], ["conv_id", "repaired_sha256"]
            )
            done = []
        if conv:
            yield pa.RecordBatch.from_arrays([pa.array([conv[0]], b.schema.field("conv_id").type), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    texts = rows.select("conv_id", "turn", "role", *_identity(), F.lit(None).cast("string").alias("act"), "text")
    marks = [F.xxhash64("conv_id", *key).alias("c1"), F.xxhash64(F.lit(1), "conv_id", *key).alias("c2")]
    texts = texts.select("*", *marks)
    texts = texts.mapInArrow(once, texts.schema).drop("c1", "c2")
    both = texts.unionByName(acts.select("conv_id", *key, "act", F.lit(None).cast("string").alias("text")))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "k1", "k2", F.col("act").desc_nulls_last()]
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "act", "text").mapInArrow(
        run, f"conv_id {kind}, repaired_sha256 string"
    )


def repair(conversations: DataFrame, rows: DataFrame | None = None, bits: int = CHUNK_BITS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of every conv_id of ``conversations`` (conv_id, turn,
    role, text), repaired after :func:`damage` (or given damaged ``rows``).

    Rows are taken by turn, null turns first; rows of one turn by role, then by
    a hash of role and text (equal rows side by side). Null conv_ids are one
    conversation. A null role or text is one space, so such a row is blank; a
    role that begins with none of s, u, a cannot be kept. A conversation that
    loses all rows has zeros, an empty audit and the hash of the empty string.
    An empty table gives an empty result; other columns are not read. SHA-256
    has to be fed in order, so the lines of one conversation stream through one
    task at the end (never held); all else is spread by chunk.
    """
    ready(conversations.sparkSession)
    rows = damage(conversations) if rows is None else rows
    found = traced(linked_chunks(rows, bits))
    acts = found.select("conv_id", F.explode(F.arrays_zip("rows", "acts")).alias("z"))
    acts = acts.select("conv_id", *[F.col(f"z.rows.{c}").alias(c) for c in ("turn", "role", "k1", "k2")], F.col("z.acts").alias("act"))
    gaps = rows.groupBy("conv_id").agg(
        F.coalesce((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("long"), F.lit(0).cast("long")).alias("gaps")
    )
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    facts = conversations.select("conv_id").distinct()
    for part in (found.select("conv_id", "chunk", *sums, "audit"), gaps, repaired_hashes(rows, acts)):
        facts = facts.unionByName(part, allowMissingColumns=True)
    piece = F.when(F.col("chunk").isNotNull(), F.struct("chunk", "audit"))
    nothing = hashlib.sha256(b"").hexdigest()
    return facts.groupBy("conv_id").agg(
        F.coalesce(F.max("gaps"), F.lit(0).cast("long")).alias("gaps"),
        *[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in sums],
        F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda p: p["audit"]), "").alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"),
    )
