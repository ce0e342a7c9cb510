from conftest import rows

from rawline.operators.audit import app_status_rows, sync_rows
from rawline.operators.publish import pending_with_decision, publish_decision, retention_candidates, sync_mark
from rawline.runtime import scratch_path
from rawline.sinks.files import path_exists, publish_partitions, write_partitioned
from rawline.sources.landing import list_versions, read_snapshot

LOG = "app_name string, table_name string, batch_no string, activity_type string"


def test_retention_candidates(spark):
    log = spark.createDataFrame(
        [
            ("a", "t", "100", "file_sync"),  # only file_sync -> candidate
            ("a", "t", "200", "file_sync"),  # synced and deleted -> not
            ("a", "t", "200", "batch_deleted"),
            ("a", "t", "300", "partition_sync"),  # never file-synced -> not
            ("a", "t", "0", "file_sync"),  # the live snapshot -> never
            ("b", "t", "400", "file_sync"),  # other app
        ],
        LOG,
    )
    got = rows(retention_candidates(log, "a", "t"))
    assert got == [("100", 1, 0, 0)]


def test_pending_and_decision(spark):
    log = spark.createDataFrame([("a", "t", "100", "file_sync"), ("a", "t", "300", "partition_sync")], LOG)
    assert sync_mark(log, "a", "t") == 100
    assert sync_mark(log, "zz", "t") == 0
    versions = spark.createDataFrame([(50,), (100,), (150,)], "t bigint")
    got = rows(pending_with_decision(versions, 100))
    assert got == [(150, 1, "publish")]
    versions2 = spark.createDataFrame([(150,), (160,)], "t bigint")
    assert {r["action"] for r in pending_with_decision(versions2, 100).collect()} == {"merge_all"}
    assert publish_decision(2, strict=True) == "skip" and publish_decision(0) == "none"


def test_audit_rows(spark):
    batches = spark.createDataFrame([("20240101000000",), ("20240102000000",)], "batchno string")
    out = app_status_rows(batches, "a", "t", "2024-01-03 00:00:00", "2024-01-03 00:05:00", 42)
    assert out.columns == ["app_name", "table_name", "batch_no", "process_start_time", "process_end_time", "record_count"]
    assert {r["record_count"] for r in out.collect()} == {42}
    dels = sync_rows(spark.createDataFrame([("100",)], "batch_no string"), "a", "t", "batch_deleted", "2024-01-03 00:00:00", 5, batch_col="batch_no")
    r = dels.first()
    assert r["record_count"] is None and r["file_sync_time"] is None and r["file_delete_time"] is not None


def test_publish_replaces_touched_and_deletes_emptied(spark):
    root = scratch_path(spark, "R_t")
    snap = f"{root}/t=0"
    base = spark.createDataFrame(
        [("k1", "aaa"), ("k2", "bbb"), ("k3", "ccc"), ("k4", None)], "id string, part_1 string"
    )
    write_partitioned(base, snap, ["part_1"], mode="overwrite")
    version = spark.createDataFrame([("k1", "bbb"), ("k2", "bbb"), ("k9", None)], "id string, part_1 string")
    write_partitioned(version, f"{root}/t=1700000000", ["part_1"], mode="overwrite")
    schema = "id string, part_1 string"
    v = read_snapshot(spark, f"{root}/t=1700000000", schema)
    # the merge touched aaa (k1 moved away), bbb and null
    deleted = publish_partitions(v, snap, ["part_1"], touched=[("aaa",), ("bbb",), (None,)])
    assert deleted == [("aaa",)]
    assert not path_exists(spark, f"{snap}/part_1=aaa")
    got = rows(read_snapshot(spark, snap, schema))
    assert got == [("k1", "bbb"), ("k2", "bbb"), ("k3", "ccc"), ("k9", None)]
    assert sorted(r["t"] for r in list_versions(spark, root).collect()) == [0, 1700000000]


def test_partitioned_write_rebalances(spark):
    from pyspark.sql import functions as F

    from rawline.sinks.files import _salted

    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("part_1"), "id")
    plan = _salted(df, ["part_1"], None, None)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    fixed = _salted(df, ["part_1"], 4, None)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(part_1" in fixed and "xxhash64" in fixed


def test_publish_keep_layout_has_no_shuffle(spark):
    root = scratch_path(spark, "keep")
    v = spark.createDataFrame([("k1", "aaa"), ("k2", "bbb")], "id string, part_1 string")
    write_partitioned(v, f"{root}/t=5", ["part_1"], mode="overwrite")
    back = read_snapshot(spark, f"{root}/t=5", "id string, part_1 string")
    assert "Exchange" not in back._jdf.queryExecution().executedPlan().toString()
    publish_partitions(back, f"{root}/t=0", ["part_1"], [("aaa",), ("bbb",)], keep_layout=True)
    assert rows(read_snapshot(spark, f"{root}/t=0", "id string, part_1 string")) == [("k1", "aaa"), ("k2", "bbb")]
