"""Snapshot as a catalog table bucketed by key: the merge moves only the
delta, and publishing keeps the bucket layout."""

import uuid

from conftest import rows

from rawline.operators.scd import apply_merge, scd1_merge, touched_partitions
from rawline.plans import feeds as fd
from rawline.plans.queries import BASE_BATCHES, DELTA_BATCHES, delta_of, snapshot_before
from rawline.runtime import scratch_path
from rawline.sinks.tables import bucket_count, create_bucketed_snapshot, publish_to_table

SF = "/root/testdata/sf0.001"


def _table(spark, df, parts=("part_1",), buckets=4):
    name = f"snap_{uuid.uuid4().hex[:8]}"
    create_bucketed_snapshot(df, name, fd.FEED_KEYS, list(parts), buckets, scratch_path(spark, name))
    return name


def _branches(plan: str):
    """(lines above the Union, lines of its last child) of a plan tree."""
    lines = plan.splitlines()
    u = next(i for i, line in enumerate(lines) if line.lstrip(" :+-").startswith("Union"))
    col = lines[u].index("Union")
    last = max(i for i in range(u + 1, len(lines)) if lines[i][col:col + 2] == "+-")
    return lines[:u], lines[last:]


def test_bucketed_merge_moves_only_the_delta(spark):
    base = snapshot_before(spark, SF, BASE_BATCHES[1])
    delta = delta_of(spark, SF, *DELTA_BATCHES, types=("click", "view"))
    name = _table(spark, base)
    n = bucket_count(spark, name)
    assert n == 4 and bucket_count(spark, f"{name}") == 4
    out = scd1_merge(delta, spark.table(name), fd.FEED_KEYS, ["part_1"], buckets=n)
    assert rows(out) == rows(scd1_merge(delta, base, fd.FEED_KEYS, ["part_1"]))
    above, base_branch = _branches(out._jdf.queryExecution().executedPlan().toString())
    assert not any("Exchange" in line for line in above)  # W2: no shuffle
    assert not any("Exchange" in line for line in base_branch)  # snapshot read in place
    scan = [line for line in base_branch if "FileScan" in line]
    assert scan and "Bucketed: true" in scan[0] and "PartitionFilters: [part_1" in scan[0]


def test_publish_to_bucketed_table_equals_apply_merge(spark):
    base = snapshot_before(spark, SF, BASE_BATCHES[1])
    delta = delta_of(spark, SF, *DELTA_BATCHES, types=("click", "view"))
    name = _table(spark, base)
    merged = scd1_merge(delta, spark.table(name), fd.FEED_KEYS, ["part_1"], buckets=bucket_count(spark, name))
    touched = touched_partitions(delta, ["part_1"])
    want = rows(apply_merge(base, scd1_merge(delta, base, fd.FEED_KEYS, ["part_1"]), touched, ["part_1"]))
    assert publish_to_table(merged, name, ["part_1"], touched) == []
    got = spark.table(name)
    assert rows(got.select(*base.columns)) == want
    assert bucket_count(spark, name) == 4


def test_publish_to_table_drops_emptied_partitions(spark):
    df = spark.createDataFrame(
        [("1", "a", "x"), ("2", "b", "y"), ("3", "n", None), ("4", "c", "w"), ("5", "q", "it's\\x")],
        "user_id string, v string, part_1 string",
    )
    name = f"snap_{uuid.uuid4().hex[:8]}"
    create_bucketed_snapshot(df, name, ["user_id"], ["part_1"], 2, scratch_path(spark, name))
    merged = spark.createDataFrame([("1", "a2", "x")], "user_id string, v string, part_1 string")
    touched = spark.createDataFrame([("x",), ("y",), (None,), ("it's\\x",)], "part_1 string")
    dropped = publish_to_table(merged, name, ["part_1"], touched)
    assert sorted(dropped, key=str) == sorted([("y",), (None,), ("it's\\x",)], key=str)
    assert rows(spark.table(name)) == [("1", "a2", "x"), ("4", "c", "w")]


def test_landing_to_table_two_runs(spark):
    """The job on the bucketed layout: same snapshot as the path-based
    job's composed merges, bucket layout kept, audit rows written."""
    from rawline.config import RawPipelineConfig
    from rawline.plans.jobs import AuditStore, landing_to_table
    from rawline.plans.queries import LANDING_SCHEMA, _ddl
    from rawline.sinks.files import write_partitioned

    root = scratch_path(spark, "tablejob")
    feed = fd.landing_feed(spark, SF)
    write_partitioned(feed, f"{root}/landing/L_events", ["batchno"], fmt="json", mode="overwrite", files_per_partition=1)
    audit = AuditStore(f"{root}/audit/app_status", f"{root}/audit/sync_status")
    cfg = RawPipelineConfig(
        appname="events_app", tablename="events", sourcepath=f"{root}/landing", targetpath=f"{root}/raw",
        keys=fd.FEED_KEYS, selectcols=fd.FEED_SELECT, rules=fd.FEED_RULES,
        startbatchno="20240101000000", endbatchno="20240119000000",
    )
    schema = _ddl(spark, LANDING_SCHEMA)
    name = f"raw_events_{uuid.uuid4().hex[:8]}"
    r1 = landing_to_table(spark, cfg, schema, audit, fd.BASE_RUN_TS, 1705708800, name, f"{root}/table", buckets=4)
    assert len(r1.batches) == 19 and bucket_count(spark, name) == 4
    cfg.startbatchno = cfg.endbatchno = None  # next run: after the mark
    r2 = landing_to_table(spark, cfg, schema, audit, fd.DELTA_RUN_TS, 1705881600, name, f"{root}/table")
    assert r2.batches[0] == "20240120000000"

    snap1 = delta_of(spark, SF, "20240101000000", "20240119000000", run_ts=fd.BASE_RUN_TS)
    d2 = delta_of(spark, SF, "20240120000000", "20240130000000", run_ts=fd.DELTA_RUN_TS)
    m2 = scd1_merge(d2, snap1, fd.FEED_KEYS, ["part_1"])
    expect = apply_merge(snap1, m2, touched_partitions(d2, ["part_1"]), ["part_1"])
    assert rows(spark.table(name).select(*snap1.columns)) == rows(expect)
    assert r2.record_count == m2.count()
    assert bucket_count(spark, name) == 4
    import os

    local = root[len("file:"):] if root.startswith("file:") else root
    for d in os.listdir(f"{local}/table"):
        if d.startswith("part_1="):
            files = [f for f in os.listdir(f"{local}/table/{d}") if not f.startswith((".", "_"))]
            assert 1 <= len(files) <= 4, (d, files)  # at most one file per bucket
    assert audit.app_status(spark).count() == 19 + len(r2.batches)
    assert rows(audit.sync_status(spark).select("batch_no", "activity_type")) == [
        ("1705708800", "file_sync"), ("1705881600", "file_sync")]


def test_landing_to_table_date_partitioned(spark):
    """Year/month/date partitions, snapshot rows chosen by date (part_3):
    the bucketed job gives the path-based job's snapshot."""
    from rawline.config import RawPipelineConfig
    from rawline.plans.jobs import AuditStore, landing_to_table
    from rawline.plans.queries import LANDING_SCHEMA, _ddl
    from rawline.sinks.files import write_partitioned

    root = scratch_path(spark, "tablejobdate")
    feed = fd.landing_feed(spark, SF)
    write_partitioned(feed, f"{root}/landing/L_events", ["batchno"], fmt="json", mode="overwrite", files_per_partition=1)
    audit = AuditStore(f"{root}/audit/app_status", f"{root}/audit/sync_status")
    cfg = RawPipelineConfig(
        appname="events_app", tablename="events", sourcepath=f"{root}/landing", targetpath=f"{root}/raw",
        keys=fd.FEED_KEYS, selectcols=fd.FEED_SELECT, rules=fd.FEED_DATE_RULES,
        startbatchno="20240101000000", endbatchno="20240120000000", date_partitioned=True,
    )
    schema = _ddl(spark, LANDING_SCHEMA)
    name = f"raw_events_{uuid.uuid4().hex[:8]}"
    landing_to_table(spark, cfg, schema, audit, fd.BASE_RUN_TS, 1705708800, name, f"{root}/table", buckets=3)
    cfg.startbatchno, cfg.endbatchno = "20240120000000", "20240121000000"  # replays 01-20
    landing_to_table(spark, cfg, schema, audit, fd.DELTA_RUN_TS, 1705881600, name, f"{root}/table")

    parts = ["part_1", "part_2", "part_3"]
    snap1 = delta_of(spark, SF, "20240101000000", "20240120000000", rules=fd.FEED_DATE_RULES, date=True, run_ts=fd.BASE_RUN_TS)
    d2 = delta_of(spark, SF, "20240120000000", "20240121000000", rules=fd.FEED_DATE_RULES, date=True, run_ts=fd.DELTA_RUN_TS)
    m2 = scd1_merge(d2, snap1, fd.FEED_KEYS, parts, touch_cols=["part_3"])
    expect = apply_merge(snap1, m2, touched_partitions(d2, ["part_3"]), ["part_3"])
    assert rows(spark.table(name).select(*snap1.columns)) == rows(expect)
