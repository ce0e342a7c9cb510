"""Property tests of the merge on small random feeds."""

import os

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rawline.functions.columns import ColumnRule
from rawline.operators.scd import apply_merge, prepare_delta, scd1_merge, touched_partitions
from rawline.runtime import scratch_path
from rawline.sinks.files import publish_partitions, write_partitioned
from rawline.sources.landing import read_snapshot

LANDING = "id string, code string, amount string, current_ts string, pos string"
SELECT = ["id", "code", "amount", "current_ts", "pos"]
RULES = [ColumnRule("part_1", "part_1", "code")]
KEYS = ["id"]
RUN = "2024-01-02 00:00:00"

# a feed row: key, partition code, amount; time and position both follow
# the row's sequence number, so W1 and W2 order rows the same way
feed_rows = st.lists(
    st.tuples(st.sampled_from(["k1", "k2", "k3", "k4", "k5"]), st.sampled_from(["aaa", "bbb", "ccc"]), st.integers(0, 99)),
    min_size=1,
    max_size=30,
)
SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def to_landing(seq, offset=0):
    return [(k, c, str(a), f"2024-01-01 00:{(i + offset) // 60:02d}:{(i + offset) % 60:02d}", str(i + offset)) for i, (k, c, a) in enumerate(seq)]


def prep(spark, data):
    return prepare_delta(spark.createDataFrame(data, LANDING), KEYS, SELECT, RULES, RUN)


@settings(**SETTINGS)
@given(base_rows=feed_rows, delta_rows=feed_rows)
def test_one_row_per_key_in_touched_partitions(spark, base_rows, delta_rows):
    base = prep(spark, to_landing(base_rows))
    delta = prep(spark, to_landing(delta_rows, offset=100))
    out = scd1_merge(delta, base, KEYS, ["part_1"])
    ids = [r["id"] for r in out.collect()]
    assert len(ids) == len(set(ids))
    touched = {r[0] for r in touched_partitions(delta, ["part_1"]).collect()}
    assert {r["part_1"] for r in out.collect()} <= touched


@settings(**SETTINGS)
@given(seq=feed_rows, k=st.integers(1, 3))
def test_sequential_batches_equal_one_batch(spark, seq, k):
    """Keys never change partition here, so scoping dedupe to touched
    partitions equals a global dedupe and batch splits do not matter."""
    code_of = {"k1": "aaa", "k2": "aaa", "k3": "bbb", "k4": "ccc", "k5": "ccc"}
    seq = [(key, code_of[key], a) for key, _, a in seq]
    data = to_landing(seq)
    empty = prep(spark, data).limit(0)
    one = apply_merge(empty, scd1_merge(prep(spark, data), empty, KEYS, ["part_1"]), touched_partitions(prep(spark, data), ["part_1"]), ["part_1"])
    snap = empty
    size = -(-len(data) // k)
    for i in range(0, len(data), size):
        d = prep(spark, data[i : i + size])
        snap = apply_merge(snap, scd1_merge(d, snap, KEYS, ["part_1"]), touched_partitions(d, ["part_1"]), ["part_1"])
        snap = spark.createDataFrame(snap.collect(), snap.schema)  # keep the plan small
    assert rows(snap) == rows(one)


def test_untouched_partition_files_stay(spark):
    root = scratch_path(spark, "prop")
    snap_path = f"{root}/t=0"
    base = prep(spark, to_landing([("k1", "aaa", 1), ("k2", "bbb", 2), ("k3", "ccc", 3)]))
    write_partitioned(base, snap_path, ["part_1"], mode="overwrite")

    def files(part):
        d = snap_path.replace("file:", "") + f"/part_1={part}"
        return {f: os.stat(os.path.join(d, f)).st_mtime_ns for f in os.listdir(d)}

    before = files("ccc")
    delta = prep(spark, to_landing([("k1", "aaa", 9), ("k4", "bbb", 8)], offset=50))
    snap = read_snapshot(spark, snap_path, delta.schema)
    merged = scd1_merge(delta, snap, KEYS, ["part_1"])
    staged = scratch_path(spark, "staged")
    merged.write.orc(staged)
    touched = [tuple(r) for r in touched_partitions(delta, ["part_1"]).collect()]
    publish_partitions(spark.read.schema(delta.schema).orc(staged), snap_path, ["part_1"], touched)
    assert files("ccc") == before
    got = rows(read_snapshot(spark, snap_path, delta.schema), "id", "amount", "part_1")
    assert got == [("k1", "9", "aaa"), ("k2", "2", "bbb"), ("k3", "3", "ccc"), ("k4", "8", "bbb")]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(base_rows=feed_rows, stale_rows=feed_rows, delta_rows=feed_rows)
def test_bucketed_snapshot_merge_and_publish_equal_plain(spark, base_rows, stale_rows, delta_rows):
    """A snapshot with stale copies of keys in other partitions (D2), kept
    as a table bucketed by key: the bucketed merge and its publish give the
    plain merge's rows and apply_merge's snapshot."""
    import uuid

    from rawline.sinks.tables import create_bucketed_snapshot, publish_to_table

    base = prep(spark, to_landing(base_rows, offset=50)).unionByName(prep(spark, to_landing(stale_rows)))
    delta = prep(spark, to_landing(delta_rows, offset=100))
    parts = ["part_1"]
    plain = scd1_merge(delta, base, KEYS, parts)
    name = f"prop_{uuid.uuid4().hex[:10]}"
    create_bucketed_snapshot(base, name, KEYS, parts, 3, scratch_path(spark, name))
    merged = scd1_merge(delta, spark.table(name), KEYS, parts, buckets=3)
    assert rows(merged.select(*plain.columns)) == rows(plain)
    touched = touched_partitions(delta, parts)
    want = rows(apply_merge(base, plain, touched, parts))
    publish_to_table(merged, name, parts, touched)
    assert rows(spark.table(name).select(*base.columns)) == want
