"""Publishing behind a manifest: one pointer switch, safe at every step."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rawline.config import RawPipelineConfig
from rawline.functions.columns import ColumnRule
from rawline.plans import jobs
from rawline.plans.jobs import AuditStore, landing_to_raw
from rawline.runtime import scratch_path
from rawline.sinks import manifest as mf
from rawline.sinks.files import path_exists, register_new_partitions, registered_partitions

SNAP = "id string, kind string, kafka_ts string, trail_file_pos string, last_updated_date string, part_1 string"


def config(root, start="20240101000000", end=None):
    return RawPipelineConfig(
        appname="app", tablename="things", sourcepath=f"{root}/landing", targetpath=f"{root}/raw", keys=["id"],
        selectcols=["id", "kind", "current_ts", "pos"], rules=[ColumnRule("part_1", "part_1", "kind")], startbatchno=start, endbatchno=end,
    )


def landing_schema(spark):
    return spark.createDataFrame([], "id bigint, kind string, current_ts string, pos string").schema


def put(spark, root, batch, items):
    """Landing lines (id, kind, pos) of a batch; kind is the partition."""
    df = spark.createDataFrame([(i, k, f"2024-01-01 00:00:{p:02d}", str(p)) for i, k, p in items], "id bigint, kind string, current_ts string, pos string")
    df.coalesce(1).write.mode("append").json(f"{root}/landing/L_things/batchno={batch}")


def run(spark, root, audit, batch, epoch, manifest=True, **more):
    cfg = config(root, batch, batch)
    return landing_to_raw(spark, cfg, landing_schema(spark), audit, "2024-02-01 00:00:00", epoch, manifest=manifest, **more)


def snapshot(spark, root, manifest=True):
    schema = spark.createDataFrame([], SNAP).schema
    rroot = f"{root}/raw/R_things"
    df = mf.read_published(spark, rroot, schema, ["part_1"]) if manifest else spark.read.schema(schema).orc(f"{rroot}/t=0")
    return rows(df, "id", "kind", "trail_file_pos", "part_1")


BATCHES = [
    ("20240101000000", [(1, "abc", 1), (2, "bcd", 1), (3, "cde", 1), (4, None, 1), (5, "R&D", 1), (6, "éco", 1), (7, "", 1)]),
    ("20240102000000", [(2, "abc", 2), (8, "bcd", 2)]),
    ("20240103000000", [(3, "cde", 3), (4, None, 3), (9, "R&D", 3), (7, "", 3)]),
]


def test_same_rows_as_the_path_layout(spark):
    a, b = scratch_path(spark, "by_path"), scratch_path(spark, "by_manifest")
    for root, manifest in ((a, False), (b, True)):
        audit = AuditStore(f"{root}/a", f"{root}/s")
        for k, (batch, items) in enumerate(BATCHES):
            put(spark, root, batch, items)
            r = run(spark, root, audit, batch, 10 + k, manifest)
            assert r.published == [10 + k]
    assert snapshot(spark, b) == snapshot(spark, a, False)
    assert len(snapshot(spark, b)) == 9


@pytest.mark.parametrize("step", ["write_manifest", "switch_pointer", "log"])
def test_stop_after_each_step_and_restart(spark, monkeypatch, step):
    root = scratch_path(spark, "stopped")
    audit = AuditStore(f"{root}/a", f"{root}/s")
    put(spark, root, *BATCHES[0])
    run(spark, root, audit, BATCHES[0][0], 10)
    before = snapshot(spark, root)
    put(spark, root, *BATCHES[1])

    class Stopped(RuntimeError):
        pass

    def stop(*_a, **_k):
        raise Stopped

    with monkeypatch.context() as m:
        if step == "log":  # after the pointer, before the audit row
            m.setattr(jobs, "_log_sync", stop)
        elif step == "switch_pointer":  # the manifest is there, the pointer is not
            m.setattr(mf, "switch_pointer", stop)
        else:
            m.setattr(mf, "write_manifest", stop)
        with pytest.raises(Stopped):
            run(spark, root, audit, BATCHES[1][0], 11)
    now = snapshot(spark, root)
    if step == "log":
        assert now != before
    else:
        assert now == before  # readers see the old snapshot, whole
    cfg = config(root, "20240109000000")  # nothing new to merge: publish what is pending
    r = landing_to_raw(spark, cfg, landing_schema(spark), audit, "2024-02-02 00:00:00", 12, manifest=True)
    assert r.published == [11]
    after = snapshot(spark, root)
    assert [x for x in after if x[0] in ("2", "8")] == [("2", "abc", "2", "abc"), ("2", "bcd", "1", "bcd"), ("8", "bcd", "2", "bcd")] or [
        x for x in after if x[0] in ("2", "8")
    ] == [("2", "abc", "2", "abc"), ("8", "bcd", "2", "bcd")]
    assert rows(audit.sync_status(spark).filter("activity_type = 'file_sync'"), "batch_no") == [("10",), ("11",)]
    r = landing_to_raw(spark, cfg, landing_schema(spark), audit, "2024-02-03 00:00:00", 13, manifest=True)
    assert r.published == [] and snapshot(spark, root) == after


def test_emptied_partition_leaves_the_manifest(spark):
    """Both rows of a partition move elsewhere in one delta that also touches it."""
    root = scratch_path(spark, "emptied")
    audit = AuditStore(f"{root}/a", f"{root}/s")
    put(spark, root, "20240101000000", [(1, "abc", 1), (2, "R&D", 1)])
    run(spark, root, audit, "20240101000000", 10)
    rroot = f"{root}/raw/R_things"
    schema = spark.createDataFrame([], SNAP).schema
    left = mf.read_published(spark, rroot, schema, ["part_1"]).filter("part_1 = 'abc'")
    touched = spark.createDataFrame([("abc",), ("R&D",)], "part_1 string")
    mf.write_manifest(mf.next_manifest(spark, rroot, ["part_1"], left, "t=10", touched), rroot, 2)
    mf.switch_pointer(spark, rroot, mf.Pointer(2, 10, 1))
    assert snapshot(spark, root) == [("1", "abc", "1", "abc")]
    mf.roll_back(spark, rroot, 1)
    assert len(snapshot(spark, root)) == 2
    with pytest.raises(ValueError):
        mf.roll_back(spark, rroot, 7)


def test_retention_keeps_what_the_manifest_names(spark):
    root = scratch_path(spark, "retired")
    audit = AuditStore(f"{root}/a", f"{root}/s")
    for k, (batch, items) in enumerate(BATCHES):
        put(spark, root, batch, items)
        r = run(spark, root, audit, batch, 10 + k)
    rroot = f"{root}/raw/R_things"
    live = {x["folder"] for x in mf.read_manifest(spark, rroot, ["part_1"]).collect()}
    assert live == {"t=10", "t=11", "t=12"} and r.deleted_versions == []
    assert not path_exists(spark, f"{rroot}/t=10/part_1=abc") and path_exists(spark, f"{rroot}/t=10/part_1=%C3%A9co") != path_exists(spark, f"{rroot}/t=10/part_1=éco")
    put(spark, root, "20240104000000", [(i, k, 9) for i, k in ((1, "abc"), (2, "bcd"), (3, "cde"), (4, None), (5, "R&D"), (6, "éco"))])
    r = run(spark, root, audit, "20240104000000", 13)
    assert r.deleted_versions == ["10", "11", "12"]
    assert rows(audit.sync_status(spark).filter("activity_type = 'batch_deleted'"), "batch_no") == [("10",), ("11",), ("12",)]
    assert len(snapshot(spark, root)) == 9


def test_several_pending_versions_are_merged_once(spark):
    root = scratch_path(spark, "several")
    audit = AuditStore(f"{root}/a", f"{root}/s")
    put(spark, root, *BATCHES[0])
    for b in BATCHES[1:]:
        put(spark, root, *b)
    strict = dict(strict_publish=True)
    run(spark, root, audit, BATCHES[0][0], 10)

    def none(*_a, **_k):
        return "none", []

    keep = jobs.publish_by_manifest
    jobs.publish_by_manifest = none
    try:
        run(spark, root, audit, BATCHES[1][0], 11)
        run(spark, root, audit, BATCHES[2][0], 12)
    finally:
        jobs.publish_by_manifest = keep
    cfg = config(root, "20240109000000")
    assert landing_to_raw(spark, cfg, landing_schema(spark), audit, "2024-02-02 00:00:00", 13, manifest=True, **strict).publish_action == "skip"
    r = landing_to_raw(spark, cfg, landing_schema(spark), audit, "2024-02-02 00:00:00", 13, manifest=True)
    assert r.published == [11, 12]
    ids = [x[0] for x in snapshot(spark, root)]
    assert sorted(ids) == sorted(set(ids)) and len(ids) == 9
    assert r.deleted_versions == ["11", "12"]


def test_first_manifest_takes_over_a_path_snapshot(spark):
    root = scratch_path(spark, "legacy")
    audit = AuditStore(f"{root}/a", f"{root}/s")
    put(spark, root, *BATCHES[0])
    run(spark, root, audit, BATCHES[0][0], 10, manifest=False)
    old = snapshot(spark, root, False)
    assert snapshot(spark, root) == old
    put(spark, root, *BATCHES[1])
    run(spark, root, audit, BATCHES[1][0], 11)
    assert {x["folder"] for x in mf.read_manifest(spark, f"{root}/raw/R_things", ["part_1"]).collect()} == {"t=0", "t=11"}


def test_run_registers_new_partitions_in_the_catalog(spark):
    import uuid

    root = scratch_path(spark, "registered")
    audit = AuditStore(f"{root}/a", f"{root}/s")
    name = f"things_{uuid.uuid4().hex[:8]}"
    put(spark, root, *BATCHES[0])
    run(spark, root, audit, BATCHES[0][0], 10, manifest=False)
    spark.sql(f"CREATE TABLE {name} ({SNAP}) USING orc PARTITIONED BY (part_1) LOCATION '{root}/raw/R_things/t=0'")
    assert spark.table(name).count() == 0  # nothing is registered yet
    put(spark, root, "20240105000000", [(50, "it's", 5), (51, "xyz", 5)])
    run(spark, root, audit, "20240105000000", 11, manifest=False, partition_table=name)
    assert rows(spark.table(name), "id", "part_1") == [(x[0], x[3]) for x in snapshot(spark, root, False)]
    assert registered_partitions(spark, name, ["part_1"]).count() == len({x[3] for x in snapshot(spark, root, False)})
    assert register_new_partitions(spark, name, ["part_1"], f"{root}/raw/R_things/t=0") == []
    spark.sql(f"DROP TABLE {name}")


def test_counts_come_from_committed_files_also_after_a_retry(spark):
    """A shuffle-map stage that runs again adds nothing to the audit count."""
    root = scratch_path(spark, "counted")
    audit = AuditStore(f"{root}/a", f"{root}/s")
    put(spark, root, *BATCHES[0])
    r = run(spark, root, audit, BATCHES[0][0], 10)
    assert r.record_count == 7
    assert audit.app_status(spark).first()["record_count"] == 7
    assert audit.sync_status(spark).filter(F.col("activity_type") == "file_sync").first()["record_count"] == 7
