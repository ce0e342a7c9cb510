"""P1 edge rows (FIXTURES: top-1 per key, merge) and properties."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rawline.functions.columns import ColumnRule
from rawline.operators.dedupe import latest_in_delta
from rawline.operators.scd import apply_merge, prepare_delta, restrict_to_touched, scd1_merge, touched_partitions
from rawline.runtime import cut_lineage, scratch_path
from rawline.sinks.files import publish_partitions, write_partitioned
from rawline.sources.landing import read_snapshot

LANDING = "id string, code string, amount string, current_ts string, pos string"
SELECT = ["id", "code", "amount", "current_ts", "pos"]
RULES = [ColumnRule("row_key", "row_key", "id"), ColumnRule("part_1", "part_1", "code")]
KEYS = ["id"]
RUN_TS = "2024-01-02 00:00:00"


def prep(spark, data, run="2024-01-02 00:00:00", **kw):
    return prepare_delta(spark.createDataFrame(data, LANDING), KEYS, SELECT, RULES, run, **kw)


def test_top1_ties_positions_and_nulls(spark):
    data = [
        ("a", "x", "1", "2024-01-01 10:00:00", "9"),
        ("a", "x", "2", "2024-01-01 10:00:00", "10"),  # same ts, larger position wins (numeric)
        ("b", "x", "3", None, "50"),  # null ts loses to any ts
        ("b", "x", "4", "2024-01-01 09:00:00", "1"),
        (None, "x", "5", "2024-01-01 08:00:00", "1"),  # null key is one group
        (None, "x", "6", "2024-01-01 07:00:00", "2"),
    ]
    df = spark.createDataFrame(data, LANDING).withColumnsRenamed({"current_ts": "kafka_ts", "pos": "trail_file_pos"})
    got = rows(latest_in_delta(df, KEYS), "id", "amount")
    assert got == [("a", "2"), ("b", "4"), (None, "5")]
    lex = rows(latest_in_delta(df, KEYS, lexicographic=True), "id", "amount")
    assert ("a", "1") in lex  # "9" > "10" as text


def test_top1_plan_has_partial_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("kafka_ts"), F.col("id").cast("string").alias("trail_file_pos"))
    plan = latest_in_delta(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def merge_fixture(spark):
    base = prep(
        spark,
        [
            ("upd", "012", "1", "2024-01-01 00:00:00", "100"),
            ("keep_t", "012", "2", "2024-01-01 00:00:00", "101"),  # only in base, touched partition
            ("keep_u", "zzz", "3", "2024-01-01 00:00:00", "102"),  # only in base, untouched
            ("older", "012", "4", "2024-01-01 00:00:00", "500"),  # base has the higher position
            ("mover", "012", "5", "2024-01-01 00:00:00", "103"),  # moves to partition "abc"
            ("nul", None, "6", "2024-01-01 00:00:00", "104"),  # null partition
        ],
        run="2024-01-01 12:00:00",
    )
    delta = prep(
        spark,
        [
            ("new", "012", "7", "2024-01-02 00:00:00", "200"),
            ("upd", "012", "8", "2024-01-02 00:00:00", "201"),
            ("older", "012", "9", "2024-01-02 00:00:00", "400"),
            ("mover", "abc", "10", "2024-01-02 00:00:00", "202"),
            ("nul2", None, "11", "2024-01-02 00:00:00", "203"),
        ],
    )
    return base, delta


def test_merge_edge_rows(spark):
    base, delta = merge_fixture(spark)
    out = scd1_merge(delta, base, KEYS, ["part_1"])
    got = {r["id"]: (r["amount"], r["part_1"]) for r in out.collect()}
    assert got == {
        "new": ("7", "012"),
        "upd": ("8", "012"),
        "keep_t": ("2", "012"),
        "older": ("4", "012"),  # delta row is older by position: base stays
        "mover": ("10", "abc"),
        "nul": ("6", None),  # null partition of base takes part
        "nul2": ("11", None),
    }
    # key only in an untouched partition is not part of the output
    assert "keep_u" not in got
    assert rows(touched_partitions(delta, ["part_1"])) == [("012",), ("abc",), (None,)]


def test_merge_is_idempotent(spark):
    base, delta = merge_fixture(spark)
    touched = touched_partitions(delta, ["part_1"])
    snap1 = apply_merge(base, scd1_merge(delta, base, KEYS, ["part_1"]), touched, ["part_1"])
    snap2 = apply_merge(snap1, scd1_merge(delta, snap1, KEYS, ["part_1"]), touched, ["part_1"])
    assert rows(snap1) == rows(snap2)


def test_merge_global_keys_removes_moved_rows(spark):
    base, delta = merge_fixture(spark)
    out = scd1_merge(delta, base, KEYS, ["part_1"], global_keys=True)
    ids = [r["id"] for r in out.collect()]
    assert sorted(ids) == sorted(set(ids)) and "keep_u" in ids


def test_input_order_does_not_matter(spark):
    rng = random.Random(7)
    data = [(f"k{rng.randrange(20)}", rng.choice(["aaa", "bbb"]), str(i), f"2024-01-01 00:00:{i % 60:02d}", str(i)) for i in range(200)]
    base = prep(spark, data[:100])
    d1 = prep(spark, data[100:])
    shuffled = list(data[100:])
    rng.shuffle(shuffled)
    d2 = prep(spark, shuffled)
    assert rows(scd1_merge(d1, base, KEYS, ["part_1"])) == rows(scd1_merge(d2, base, KEYS, ["part_1"]))


def test_orc_base_scan_is_pruned(spark):
    base, delta = merge_fixture(spark)
    path = scratch_path(spark, "snap")
    write_partitioned(base, path, ["part_1"], mode="overwrite")
    schema = (
        "id string, code string, amount string, kafka_ts string, trail_file_pos string, "
        "last_updated_date string, row_key string, part_1 string"
    )
    snap = read_snapshot(spark, path, schema)
    # "012" stays text when read back with the declared type
    assert rows(snap.filter("id = 'upd'"), "part_1") == [("012",)]
    out = scd1_merge(delta, snap, KEYS, ["part_1"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "isnull(part_1" in plan
    got = {r["id"]: r["amount"] for r in out.collect()}
    assert got["nul"] == "6" and "keep_u" not in got


def test_merge_fills_new_landing_column(spark):
    base, delta = merge_fixture(spark)
    wider = delta.withColumn("note", F.lit("n"))
    out = scd1_merge(wider, base, KEYS, ["part_1"])
    got = {r["id"]: r["note"] for r in out.collect()}
    assert got["new"] == "n" and got["keep_t"] is None


def test_merge_same_lineage_multi_part(spark):
    """Snapshot and delta cut from one frame: joins must not go ambiguous."""
    rules = [ColumnRule("part_1", "p1", "code"), ColumnRule("part_2", "p2", "kafka_ts")]
    data = [("a", "x", "1", "2024-01-01 00:00:00", "1"), ("b", "y", "2", "2024-02-01 00:00:00", "2"),
            ("a", "x", "3", "2024-01-05 00:00:00", "3"), ("c", None, "4", "2024-03-01 00:00:00", "4")]
    landing = spark.createDataFrame(data, LANDING)
    prep_all = prepare_delta(landing, KEYS, SELECT, rules, RUN_TS)
    base = prep_all.filter("trail_file_pos in ('1', '2', '4')")
    delta = prep_all.filter("trail_file_pos = '3'")
    out = scd1_merge(delta, base, KEYS, ["p1", "p2"])
    assert rows(out, "id", "amount") == [("a", "3")]
    snap = apply_merge(base, out, touched_partitions(delta, ["p1", "p2"]), ["p1", "p2"])
    assert rows(snap, "id", "amount") == [("a", "3"), ("b", "2"), ("c", "4")]


@pytest.mark.parametrize("n", [10, 20_000])
def test_snapshot_scan_is_pruned_whatever_the_number_of_touched_values(spark, n):
    path = scratch_path(spark, "pruned")
    spark.createDataFrame([("k1", "v1"), ("k2", "other")], "id string, part_1 string").write.partitionBy("part_1").orc(path)
    snap = spark.read.schema("id string, part_1 string").orc(path)
    touched = spark.range(n).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("part_1"))
    out = restrict_to_touched(snap, touched, ["part_1"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part_1" in plan and "Join" not in plan
    assert rows(out) == [("k1", "v1")]


@pytest.mark.parametrize("value", [None, "", "R&D", "A+B", "éco", "ab,", "a@b", "x(y", "a b", "50%", "2024-01-01", "a=b/c:d"])
def test_publish_keeps_and_deletes_odd_partitions(spark, value):
    """The partition is read back, merged and, once emptied, deleted."""
    path = scratch_path(spark, "odd")
    snap_ddl = "id string, v string, part_1 string"
    base = [("1", "a", value), ("2", "b", value), ("3", "c", "abc")]
    write_partitioned(spark.createDataFrame(base, snap_ddl), path, ["part_1"], mode="overwrite")
    snap = read_snapshot(spark, path, snap_ddl)
    stored = value or None
    delta = spark.createDataFrame([("9", "d", value)], snap_ddl)
    kept = restrict_to_touched(snap, touched_partitions(delta, ["part_1"]), ["part_1"])
    assert rows(kept, "id", "part_1") == [("1", stored), ("2", stored)]
    merged = cut_lineage(delta.unionByName(kept))
    assert publish_partitions(merged, path, ["part_1"], [(value,)]) == []
    assert rows(read_snapshot(spark, path, snap_ddl), "id") == [("1",), ("2",), ("3",), ("9",)]
    moved = spark.createDataFrame([(i, "m", "abc") for i in "1239"], snap_ddl)
    assert publish_partitions(moved, path, ["part_1"], [(value,), ("abc",)]) == [(stored,)]
    assert rows(read_snapshot(spark, path, snap_ddl), "id", "part_1") == [(i, "abc") for i in "1239"]


def test_touch_cols_date_only(spark):
    """part_1 from one column, part_3 from another: selecting the snapshot
    by part_3 alone (the reference's rule) takes rows the tuple rule skips."""
    rules = [ColumnRule("part_1", "p1", "code"), ColumnRule("part_3", "p3", "kafka_ts")]
    base = prepare_delta(
        spark.createDataFrame([("b", "aaa", "1", "2024-01-05 00:00:00", "1")], LANDING), KEYS, SELECT, rules, RUN_TS
    )
    delta = prepare_delta(
        spark.createDataFrame([("d", "zzz", "2", "2024-01-05 10:00:00", "2")], LANDING), KEYS, SELECT, rules, RUN_TS
    )
    by_tuple = {r["id"] for r in scd1_merge(delta, base, KEYS, ["p1", "p3"]).collect()}
    by_date = {r["id"] for r in scd1_merge(delta, base, KEYS, ["p1", "p3"], touch_cols=["p3"]).collect()}
    assert by_tuple == {"d"} and by_date == {"b", "d"}


def test_null_partitions_are_values(spark):
    """Touched tuples with nulls: matched as values in merge and snapshot."""
    rules = [ColumnRule("part_1", "p1", "code"), ColumnRule("part_2", "p2", "amount")]
    data = [("a", "x", "1", "2024-01-01 00:00:00", "1"), ("b", None, "2", "2024-02-01 00:00:00", "2"),
            ("c", "y", None, "2024-03-01 00:00:00", "3"), ("d", "z", "4", "2024-03-02 00:00:00", "4"),
            ("b", None, "2", "2024-02-03 00:00:00", "5"), ("c", "y", None, "2024-03-04 00:00:00", "6"),
            ("e", "x", "1", "2024-03-05 00:00:00", "7")]
    prep_all = prepare_delta(spark.createDataFrame(data, LANDING), KEYS, SELECT, rules, RUN_TS)
    base = prep_all.filter("trail_file_pos in ('1', '2', '3', '4')")
    delta = prep_all.filter("trail_file_pos in ('5', '6', '7')")
    parts = ["p1", "p2"]
    out = scd1_merge(delta, base, KEYS, parts)
    assert rows(out, "id", "trail_file_pos") == [("a", "1"), ("b", "5"), ("c", "6"), ("e", "7")]
    touched = touched_partitions(delta, parts)
    assert rows(apply_merge(base, out, touched, parts), "id", "trail_file_pos") == [("a", "1"), ("b", "5"), ("c", "6"), ("d", "4"), ("e", "7")]


def test_indexed_merge_reads_only_touched_and_indexed_partitions(spark):
    from rawline.operators import scd
    from rawline.runtime import scratch_path
    from rawline.sinks.files import write_key_index, write_partitioned
    from rawline.sources.landing import read_snapshot

    cols = "id string, v string, kafka_ts string, trail_file_pos string, part_1 string"
    schema = spark.createDataFrame([], cols).schema
    snap = spark.createDataFrame([(str(i), "old", "t", "1", f"p{i % 6}") for i in range(60)] + [("n", "old", "t", "1", None)], schema)
    root, at = scratch_path(spark, "snap"), scratch_path(spark, "index")
    write_partitioned(snap, root, ["part_1"])
    base = read_snapshot(spark, root, schema)
    write_key_index(scd.key_index(base, ["id"], ["part_1"], 4), at)
    index = spark.read.schema(f"id string, part_1 string, {scd.BUCKET_COL} int").orc(at)
    # 1 moves p1 -> p2, n leaves the null partition, new key in p3, 8 is older than the snapshot's row
    delta = spark.createDataFrame(
        [("1", "new", "t", "2", "p2"), ("n", "new", "t", "2", "p2"), ("x", "new", "t", "2", "p3"), ("4", "late", "t", "0", "p2")], schema
    )
    merged, rewritten = scd.scd1_merge_indexed(delta, base, index, ["id"], ["part_1"], 4)
    assert rows(rewritten) == [("p1",), ("p2",), ("p3",), ("p4",), (None,)]
    whole = scd.scd1_merge(delta, base, ["id"], ["part_1"], global_keys=True)
    assert rows(scd.apply_merge(base, merged, rewritten, ["part_1"])) == rows(whole)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan orc" in x and "trail_file_pos" in x)
    assert "part_1" in scan.split("PartitionFilters")[1] and "p5" not in scan and "p0" not in scan
    # the index after the merge names where every key lies now
    write_key_index(materialized(scd.moved_index(index, merged, ["id"], ["part_1"], 4)), at)
    spark.catalog.refreshByPath(at)
    now = spark.read.schema(f"id string, part_1 string, {scd.BUCKET_COL} int").orc(at)
    assert rows(now, "id", "part_1") == rows(whole, "id", "part_1")


def materialized(df):
    from rawline.runtime import materialize

    return materialize(df, "test")
