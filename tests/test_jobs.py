"""Landing -> raw job end to end on a landing folder built from events."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rawline.config import RawPipelineConfig
from rawline.operators.scd import apply_merge, scd1_merge, touched_partitions
from rawline.plans import feeds as fd
from rawline.plans.jobs import AuditStore, generate_flat, landing_to_raw
from rawline.plans.queries import LANDING_SCHEMA, _ddl, delta_of
from rawline.runtime import scratch_path
from rawline.sinks.files import path_exists, write_partitioned
from rawline.sources.landing import read_snapshot

SF = "/root/testdata/sf0.001"


def test_landing_to_raw_two_runs(spark):
    root = scratch_path(spark, "job")
    feed = fd.landing_feed(spark, SF)
    write_partitioned(feed, f"{root}/landing/L_events", ["batchno"], fmt="json", mode="overwrite", files_per_partition=1)
    audit = AuditStore(f"{root}/audit/app_status", f"{root}/audit/sync_status")
    cfg = RawPipelineConfig(
        appname="events_app",
        tablename="events",
        sourcepath=f"{root}/landing",
        targetpath=f"{root}/raw",
        keys=fd.FEED_KEYS,
        selectcols=fd.FEED_SELECT,
        rules=fd.FEED_RULES,
        startbatchno="20240101000000",
        endbatchno="20240119000000",
    )
    schema = _ddl(spark, LANDING_SCHEMA)
    r1 = landing_to_raw(spark, cfg, schema, audit, fd.BASE_RUN_TS, 1705708800)
    assert len(r1.batches) == 19 and r1.publish_action == "publish" and r1.deleted_versions == ["1705708800"]
    cfg.startbatchno = cfg.endbatchno = None  # next run: after the mark
    r2 = landing_to_raw(spark, cfg, schema, audit, fd.DELTA_RUN_TS, 1705881600)
    assert r2.batches[0] == "20240120000000" and r2.published == [1705881600]
    assert not path_exists(spark, f"{root}/raw/R_events/t=1705881600")

    snap1 = delta_of(spark, SF, "20240101000000", "20240119000000", run_ts=fd.BASE_RUN_TS)
    d2 = delta_of(spark, SF, "20240120000000", "20240130000000", run_ts=fd.DELTA_RUN_TS)
    expect = apply_merge(snap1, scd1_merge(d2, snap1, fd.FEED_KEYS, ["part_1"]), touched_partitions(d2, ["part_1"]), ["part_1"])
    got = read_snapshot(spark, f"{root}/raw/R_events/t=0", snap1.schema)
    assert rows(got) == rows(expect)
    assert r2.record_count == scd1_merge(d2, snap1, fd.FEED_KEYS, ["part_1"]).count()

    log = audit.sync_status(spark)
    acts = rows(log.groupBy("activity_type").count())
    assert acts == [("batch_deleted", 2), ("file_sync", 2)]
    assert audit.app_status(spark).count() == 19 + len(r2.batches)


def test_generate_flat(spark):
    root = scratch_path(spark, "flatjob")
    res = generate_flat(fd.tax_lines(spark, SF), root, "gstr1", "2024-01-22", f"{root}/summary")
    assert res["files"] == 5 and res["records"] > 0
    names = [o.rsplit("/", 1)[-1] for o in res["outputs"]]
    assert "gstr1_1-URGENT_2024-01-22.csv" in names and len(names) == 5
    back = spark.read.option("header", True).csv(res["outputs"][0])
    assert back.count() > 0 and "gstin_hash" in back.columns
    s = spark.read.option("header", True).csv(f"{root}/summary").first()
    assert s["status"] == "COMPLETED"


def test_trusted_to_external(spark):
    import pytest

    from rawline.config import ExternalConfig
    from rawline.plans.jobs import PushFailed, trusted_to_external
    from scripted import cod_push_client
    from rawline.runtime import ship_package

    ship_package(spark)
    root = scratch_path(spark, "ext")
    cfg = ExternalConfig("cod_app", "cod", f"{root}/status", f"{root}/errors")
    audit = AuditStore(f"{root}/audit/app_status", f"{root}/audit/sync_status")
    src = fd.cod_list(spark, SF)
    with pytest.raises(PushFailed):
        trusted_to_external(src, cfg, cod_push_client, audit, "PRD", "2024-01-22 00:00:00", "20240122000000", "2024-01-22",
                            "error string, op string, first bigint", size=10)
    status = spark.read.orc(f"{root}/status")
    errors = spark.read.orc(f"{root}/errors")
    n_ok, n_err = status.count(), errors.count()
    assert n_ok > 0 and n_err > 0
    assert status.select("batch_no").distinct().first()[0] in ("20240122000000", 20240122000000)
    # a failed run leaves no mark, so its ids are extracted again; a good one counts all extracted rows
    assert audit.app_status(spark).count() == 0
    trusted_to_external(src, cfg, lambda p: (200, "{}"), audit, "PRD", "2024-01-23 00:00:00", "20240123000000", "2024-01-23", size=10)
    assert rows(audit.app_status(spark), "batch_no", "record_count") == [("20240123000000", src.count())]


def test_requests_of_a_job_run_in_several_tasks(spark):
    from rawline.config import ExternalConfig
    from rawline.plans.jobs import trusted_to_external
    from rawline.runtime import ship_package

    def client(params):
        from pyspark import TaskContext

        return 200 + 200 * (TaskContext.get().partitionId() > 0), "{}"  # 400 from every task but the first

    ship_package(spark)
    root = scratch_path(spark, "spread")
    cfg = ExternalConfig("cod_app", "cod", f"{root}/status", f"{root}/errors")
    audit = AuditStore(f"{root}/audit/app_status", f"{root}/audit/sync_status")
    src = spark.range(400).select(F.col("id").alias("CUST_ID"), F.lit(1).alias("COD_ALLOWED"))
    from rawline.plans.jobs import PushFailed

    with pytest.raises(PushFailed):
        trusted_to_external(src, cfg, client, audit, "PRD", "2024-01-22 00:00:00", "20240122000000", "2024-01-22", size=1, num_partitions=4)
    n_ok = spark.read.orc(f"{root}/status").count()
    assert 0 < n_ok < 300 and n_ok + spark.read.orc(f"{root}/errors").count() == 400


def test_fetch_gst(spark):
    from rawline.plans.jobs import fetch_gst
    from scripted import gst_fetch_client
    from rawline.runtime import ship_package

    ship_package(spark)
    root = scratch_path(spark, "gst")
    sched = fd.schedules(spark, SF).filter(F.col("schedule_id") == "ASIA")
    res = fetch_gst(fd.sessions(spark, SF), sched, fd.gst_status(spark, SF), gst_fetch_client, "http://api.test",
                    "gstin string, fy string, section string", f"{root}/out", "2024-01-22", backoff=False)
    m = res["metrics"]
    assert m["api_success"] + m["api_failure"] == res["fetched"].count()
    out = spark.read.json(f"{root}/out")
    assert set(out.columns) >= {"gstin", "section", "gst_type", "fy"}
    assert res["failures"].filter("action_type = 'API_CALL_ERROR'").count() == m["api_failure"]


def test_catalog_audit_store_and_idempotency_key(spark):
    from rawline.operators import external as ext
    from rawline.plans.jobs import CatalogAuditStore
    from rawline.runtime import ship_package

    root = scratch_path(spark, "cat")
    store = CatalogAuditStore(f"{root}/app_status", f"{root}/sync_status", "t_app_status", "t_sync_status")
    one = spark.createDataFrame([("20240101000000",)], "batchno string")
    from rawline.operators.audit import app_status_rows

    store.append_app_status(app_status_rows(one, "a", "t", "2024-01-02 00:00:00", "2024-01-02 00:00:00", 3))
    store.append_app_status(app_status_rows(one, "a", "t", "2024-01-03 00:00:00", "2024-01-03 00:00:00", 4))
    assert spark.table("t_app_status").count() == 2

    ship_package(spark)
    df = spark.range(3).select(F.col("id").alias("CUST_ID"), F.lit("allow").alias("operation"))
    payload = ext.number_requests(ext.request_batches(df, size=2))
    seen = ext.push_requests(payload, lambda p: (200, p["key"]), key_param="key", run_batch="20240101000000")
    assert sorted(r["body"] for r in seen.collect()) == ["20240101000000000001", "20240101000000000002"]


def test_cli_landing_to_raw(spark, tmp_path):
    import json as _json

    from rawline.__main__ import main as cli

    root = scratch_path(spark, "cli")
    feed = fd.landing_feed(spark, SF).filter(F.col("batchno") <= "20240105000000")
    write_partitioned(feed, f"{root}/landing/L_events", ["batchno"], fmt="json", mode="overwrite", files_per_partition=1)
    sample = f"{root}/sample"
    feed.drop("batchno").limit(5).write.json(sample)
    cfg = {"rawpipeline": {"appname": "a", "tablename": "events", "sourcepath": f"{root}/landing",
                           "targetpath": f"{root}/raw", "startbatchno": "20240101000000", "endbatchno": None,
                           "scd1column": "user_id", "selectcols": "user_id,event_type,value,current_ts,pos",
                           "schemafile": sample,
                           "additional_columns": [{"columnkey": "part_1", "columnname": "part_1", "columnformula": "event_type"}]}}
    p = tmp_path / "cfg.json"
    p.write_text(_json.dumps(cfg))
    assert cli(["landing_to_raw", "--config", str(p), "--audit", f"{root}/audit",
                "--run-ts", "2024-01-06 00:00:00", "--run-epoch", "1704499200"]) == 0
    snap = spark.read.orc(f"{root}/raw/R_events/t=0")
    assert snap.count() == feed.select("user_id").distinct().count()
    # the same run into a bucketed catalog snapshot
    assert cli(["landing_to_raw", "--config", str(p), "--audit", f"{root}/audit2",
                "--run-ts", "2024-01-06 00:00:00", "--run-epoch", "1704499200",
                "--table", "cli_events", "--table-path", f"{root}/table", "--buckets", "3"]) == 0
    assert rows(spark.table("cli_events").select(*snap.columns)) == rows(snap)


def test_landing_to_raw_date_partitioned(spark):
    """Date layout (year, month, date of kafka_ts): two runs, the second
    replays a batch; the published snapshot equals the composed merges."""
    root = scratch_path(spark, "jobdate")
    feed = fd.landing_feed(spark, SF)
    write_partitioned(feed, f"{root}/landing/L_events", ["batchno"], fmt="json", mode="overwrite", files_per_partition=1)
    audit = AuditStore(f"{root}/audit/app_status", f"{root}/audit/sync_status")
    cfg = RawPipelineConfig(
        appname="events_app", tablename="events", sourcepath=f"{root}/landing", targetpath=f"{root}/raw",
        keys=fd.FEED_KEYS, selectcols=fd.FEED_SELECT, rules=fd.FEED_DATE_RULES,
        startbatchno="20240101000000", endbatchno="20240120000000", date_partitioned=True,
    )
    schema = _ddl(spark, LANDING_SCHEMA)
    landing_to_raw(spark, cfg, schema, audit, fd.BASE_RUN_TS, 1705708800)
    cfg.startbatchno, cfg.endbatchno = "20240120000000", "20240121000000"  # replays 01-20
    r2 = landing_to_raw(spark, cfg, schema, audit, fd.DELTA_RUN_TS, 1705881600)
    assert r2.publish_action == "publish"

    parts = ["part_1", "part_2", "part_3"]
    snap1 = delta_of(spark, SF, "20240101000000", "20240120000000", rules=fd.FEED_DATE_RULES, date=True, run_ts=fd.BASE_RUN_TS)
    d2 = delta_of(spark, SF, "20240120000000", "20240121000000", rules=fd.FEED_DATE_RULES, date=True, run_ts=fd.DELTA_RUN_TS)
    m2 = scd1_merge(d2, snap1, fd.FEED_KEYS, parts, touch_cols=["part_3"])
    expect = apply_merge(snap1, m2, touched_partitions(d2, ["part_3"]), ["part_3"])
    got = read_snapshot(spark, f"{root}/raw/R_events/t=0", snap1.schema)
    assert rows(got) == rows(expect)


def test_cli_cod_push_and_gst_fetch(spark, tmp_path):
    import json as _json

    from rawline.__main__ import main as cli

    root = scratch_path(spark, "cli2")
    fd.cod_list(spark, SF).write.parquet(f"{root}/cod")
    (tmp_path / "cod.json").write_text(_json.dumps({"externalpipeline": {
        "app_name": "cod_app", "table_name": "cod", "statuspath": f"{root}/status", "errorpath": f"{root}/errors"}}))
    code = cli(["cod_push", "--config", str(tmp_path / "cod.json"), "--audit", f"{root}/audit",
                "--client", "scripted:cod_push_client", "--source", f"{root}/cod", "--env", "PRD",
                "--run-ts", "2024-01-22 00:00:00", "--run-batch", "20240122000000", "--record-date", "2024-01-22",
                "--error-schema", "error string, op string, first bigint"])
    # 700 ids per request: one request per operation here, both accepted
    assert code == 0
    assert spark.read.orc(f"{root}/status").count() == 2 and not path_exists(spark, f"{root}/errors")

    fd.sessions(spark, SF).write.option("header", False).csv(f"{root}/sessions")
    fd.gst_status(spark, SF).write.option("header", True).csv(f"{root}/gststatus")
    sched = [r.asDict() for r in fd.schedules(spark, SF).collect()]
    (tmp_path / "gst.json").write_text(_json.dumps({"config": {
        "rootpath": root, "datapath": "d/", "statuspath": "s/", "sessionpath": "x/", "schedule": sched}}))
    code = cli(["gst_fetch", "--config", str(tmp_path / "gst.json"), "--schedule-id", "ASIA",
                "--sessions", f"{root}/sessions", "--status", f"{root}/gststatus",
                "--client", "scripted:gst_fetch_client", "--base-url", "http://api.test",
                "--data-schema", "gstin string, fy string, section string", "--out", f"{root}/gstout",
                "--run-ts", "2024-01-22", "--no-backoff"])
    assert code == 0
    expected = rsp_valid_count(spark)
    assert spark.read.json(f"{root}/gstout").count() == expected


def rsp_valid_count(spark):
    """Rows the same fetch writes when run through the library directly."""
    from scripted import gst_fetch_client

    from rawline.operators import responses as rsp

    sched = fd.schedules(spark, SF).filter(F.col("schedule_id") == "ASIA")
    reqs = rsp.request_fanout(fd.sessions(spark, SF), sched, "http://api.test")
    fetched = rsp.fetch_table(reqs, gst_fetch_client, backoff=False).filter(F.col("outcome") == "ok")
    data = rsp.parse_data(rsp.parse_envelope(fetched), "gstin string, fy string, section string", ["gst_type", "fy"])
    return rsp.valid_records(data, fd.gst_status(spark, SF)).count()


def test_fetch_gst_reports_what_does_not_parse_and_empty_types(spark):
    from rawline.plans.jobs import fetch_gst
    from rawline.runtime import ship_package

    def client(request, attempt):
        body = {"a": '{"status": "success", "data": [{"gstin": "a", "n": 1}, {"gstin": "a", "n": 2}]}', "b": "cut {", "c": '{"status": "success", "data": "[{"}'}
        return 200, body[request["gstin"]]

    ship_package(spark)
    root = scratch_path(spark, "honest")
    sessions = spark.createDataFrame([(g, "s") for g in "abc"], "GSTIN1 string, SECTION1 string")
    sched = spark.createDataFrame([("t1", "y"), ("t2", "y")], "gst_type string, fy string")
    status = spark.createDataFrame([("a", "t1", "y", "VALID"), ("a", "t2", "y", "CANCELLED")], "gstin string, gst_type string, fy string, status string")
    res = fetch_gst(sessions, sched, status, client, "http://h", "gstin string, n int", f"{root}/out", "2024-01-22", backoff=False, summary_path=f"{root}/summary")
    assert rows(spark.read.json(f"{root}/out"), "gst_type", "gstin", "n") == [("t1", "a", 1), ("t1", "a", 2)]
    assert rows(res["failures"], "action_type", "data") == [("API_PARSE_ERROR", "b")] * 2 + [("API_PARSE_ERROR", "c")] * 2
    assert sorted(r[0].split(",")[:3] for r in spark.read.text(f"{root}/summary").collect()) == [["t1", "y", "2"], ["t2", "y", "0"]]
