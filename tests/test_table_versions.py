"""Versions of a bucketed catalog table: published by partition locations."""

import uuid

from conftest import rows
from test_manifest import BATCHES, config, landing_schema, put

from rawline.plans import jobs
from rawline.plans.jobs import AuditStore, landing_to_raw, landing_to_table, versions_dir
from rawline.runtime import scratch_path
from rawline.sinks import tables as tb
from rawline.sinks.files import list_children


def run(spark, root, audit, batch, epoch, table, **more):
    return landing_to_table(
        spark, config(root, batch, batch), landing_schema(spark), audit, "2024-02-01 00:00:00", epoch, table, f"{root}/table", buckets=3, versions=True, **more
    )


def content(spark, table):
    return rows(spark.table(table), "id", "kind", "trail_file_pos", "part_1")


def test_same_rows_as_the_path_layout_after_two_versions_and_a_cleanup(spark):
    root, other = scratch_path(spark, "tv"), scratch_path(spark, "tvpath")
    audit, plain = AuditStore(f"{root}/a", f"{root}/s"), AuditStore(f"{other}/a", f"{other}/s")
    table = f"tv_{uuid.uuid4().hex[:8]}"
    for k, (batch, items) in enumerate(BATCHES):
        put(spark, root, batch, items)
        put(spark, other, batch, items)
        r = run(spark, root, audit, batch, 10 + k, table)
        assert r.published == [10 + k]
        landing_to_raw(spark, config(other, batch, batch), landing_schema(spark), plain, "2024-02-01 00:00:00", 10 + k)
    schema = "id string, kind string, kafka_ts string, trail_file_pos string, last_updated_date string, part_1 string"
    want = rows(spark.read.schema(schema).orc(f"{other}/raw/R_things/t=0"), "id", "kind", "trail_file_pos", "part_1")
    assert content(spark, table) == want
    # the merge still reads the moved partitions bucket by bucket
    plan = spark.table(table).groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    # all partitions move on: the versions that nothing lies in go, and are logged
    before = rows(audit.sync_status(spark).filter("activity_type = 'batch_deleted'"))
    put(spark, root, "20240104000000", [(i, k, 9) for i, k in ((1, "abc"), (2, "bcd"), (3, "cde"), (4, None), (5, "R&D"), (6, "éco"))])
    r = run(spark, root, audit, "20240104000000", 13, table)
    assert before == [] and r.deleted_versions == ["11", "12"]
    assert [n for n in list_children(spark, versions_dir(f"{root}/table")) if n.startswith("t=")] == ["t=13"]
    latest = content(spark, table)
    tb.roll_back_table(spark, table, ["part_1"], f"{versions_dir(f'{root}/table')}/_before/t=11")
    assert len(content(spark, table)) == 7  # the first run's snapshot lies in the table's own folder
    tb.publish_table_version(spark, table, ["part_1"], f"{versions_dir(f'{root}/table')}/t=13", None, f"{versions_dir(f'{root}/table')}/_before/t=13")
    assert [x for x in latest if x[2] == "9"] == [x for x in content(spark, table) if x[2] == "9"]
    spark.sql(f"DROP TABLE {table}")


def test_stopped_publish_and_several_pending_versions(spark, monkeypatch):
    root = scratch_path(spark, "tvstop")
    audit = AuditStore(f"{root}/a", f"{root}/s")
    table = f"tv_{uuid.uuid4().hex[:8]}"
    for batch, items in BATCHES:
        put(spark, root, batch, items)
    run(spark, root, audit, BATCHES[0][0], 10, table)
    real = jobs.publish_table_versions
    monkeypatch.setattr(jobs, "publish_table_versions", lambda *a, **k: ("none", []))
    run(spark, root, audit, BATCHES[1][0], 11, table)
    run(spark, root, audit, BATCHES[2][0], 12, table)
    monkeypatch.setattr(jobs, "publish_table_versions", real)
    cfg = config(root, "20240109000000")
    again = lambda **more: landing_to_table(
        spark, cfg, landing_schema(spark), audit, "2024-02-02 00:00:00", 13, table, f"{root}/table", versions=True, **more
    )
    assert again(strict_publish=True).publish_action == "skip"
    r = again()
    assert r.published == [11, 12] and r.deleted_versions == ["11", "12"]
    ids = [x[0] for x in content(spark, table)]
    assert len(ids) == 9 and len(set(ids)) == 9
    spark.sql(f"DROP TABLE {table}")
