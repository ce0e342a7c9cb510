"""Landing lines that cannot take part are kept apart, none is lost."""

import json

from conftest import rows
from pyspark.sql import functions as F

from rawline.operators.batches import processed_batches, unprocessed_batches
from rawline.plans.jobs import AuditStore, landing_to_raw
from rawline.runtime import scratch_path
from rawline.sources.landing import stage_landing
from test_manifest import config, landing_schema, put

DDL = "id bigint, v decimal(18,2), t string"


def staged(spark, lines, keys=("id",)):
    root = scratch_path(spark, "lines")
    for batch, own in lines.items():
        spark.createDataFrame([(x,) for x in own], "value string").coalesce(1).write.text(f"{root}/batchno={batch}")
    schema = spark.createDataFrame([], DDL).schema
    return stage_landing(spark, root, schema, sorted(lines), list(keys))


def test_every_line_is_good_or_quarantined_with_its_reason(spark):
    lines = {
        "20240101000000": ['{"id":1,"v":"1.50","t":"x"}', "", "  ", '{"id":2,"v":', '{"id":"x","v":2}', '{"v":3}', '[{"id":4}]', "plain", '{"id":7,"more":{"a":1}}'],
        "20240102000000": ['{"id":9,"t":5}', '{"id":9.5}', '{"id":null}', '{"id":6,"v":"abc"}', "{}"],
    }
    st = staged(spark, lines)
    assert rows(st.good, "id", "v", "t", "batchno") == [
        (1, st.good.filter("id = 1").first()["v"], "x", "20240101000000"), (7, None, None, "20240101000000"), (9, None, "5", "20240102000000"),
    ]
    assert rows(st.quarantined, "reason", "line", "batchno") == sorted([
        ("null key", '{"id":null}', "20240102000000"), ("null key", '{"v":3}', "20240101000000"), ("null key", "{}", "20240102000000"),
        ("unreadable", '[{"id":4}]', "20240101000000"), ("unreadable", "plain", "20240101000000"), ("unreadable", '{"id":2,"v":', "20240101000000"),
        ("value does not cast", '{"id":"x","v":2}', "20240101000000"), ("value does not cast", '{"id":6,"v":"abc"}', "20240102000000"),
        ("value does not cast", '{"id":9.5}', "20240102000000"),
    ])
    assert (st.n_good, st.n_quarantined) == (3, 9)


def test_no_batches_and_no_bad_lines(spark):
    st = staged(spark, {})
    assert (st.n_good, st.n_quarantined, st.good.count()) == (0, 0, 0)
    st = staged(spark, {"20240101000000": ['{"id":1}']})
    assert (st.n_good, st.n_quarantined, st.quarantined.count()) == (1, 0, 0)


def test_which_columns_a_plan_reads_does_not_change_what_is_good(spark):
    st = staged(spark, {"20240101000000": ['{"id":1,"v":"abc"}', '{"id":2}']})
    assert rows(st.good, "id") == [(2,)] and st.quarantined.select("batchno").count() == 1


def test_job_writes_the_quarantine_by_batch_and_merges_the_rest(spark):
    root = scratch_path(spark, "quarantined")
    cfg, audit = config(root), AuditStore(f"{root}/a", f"{root}/s")
    put(spark, root, "20240101000000", [(1, "a", 1), (2, "b", 2)])
    bad = ['{"id": 3, "kind": "a", "current_ts"', json.dumps({"id": "x", "kind": "a", "current_ts": "t", "pos": "3"}), json.dumps({"kind": "a"})]
    spark.createDataFrame([(x,) for x in bad], "value string").write.mode("append").text(f"{root}/landing/L_things/batchno=20240101000000")
    for _ in range(2):  # the same batch again replaces its lines
        r = landing_to_raw(spark, cfg, landing_schema(spark), audit, "2024-02-01 00:00:00", 1 + audit.sync_status(spark).count())
        assert (r.record_count, r.quarantined) == (2, 3)
    q = spark.read.schema("line string, reason string, batchno string").orc(f"{root}/raw/Q_things")
    assert rows(q, "reason", "batchno") == [(x, "20240101000000") for x in ("null key", "unreadable", "value does not cast")]


def test_late_batch_is_taken_once_and_ranges_stay(spark):
    root = scratch_path(spark, "late")
    audit = AuditStore(f"{root}/a", f"{root}/s")
    for day in ("02", "03", "05"):
        put(spark, root, f"202401{day}000000", [(int(day), "a", int(day))])
    first = config(root, start="20240102000000")
    assert landing_to_raw(spark, first, landing_schema(spark), audit, "2024-02-01 00:00:00", 1).batches == ["20240102000000", "20240103000000", "20240105000000"]
    put(spark, root, "20240104000000", [(4, "a", 4)])  # arrives below the mark
    put(spark, root, "20240101000000", [(1, "a", 1)])  # before the first run's start: left out on purpose
    put(spark, root, "20240106000000", [(6, "a", 6)])
    run = config(root, start=None)
    assert landing_to_raw(spark, run, landing_schema(spark), audit, "2024-02-02 00:00:00", 2).batches == ["20240104000000", "20240106000000"]
    assert landing_to_raw(spark, run, landing_schema(spark), audit, "2024-02-03 00:00:00", 3).batches == []
    assert rows(spark.read.orc(f"{root}/raw/R_things/t=0").select(F.col("id").cast("int"))) == [(i,) for i in range(2, 7)]


def test_ledger_is_per_app_and_table(spark):
    status = spark.createDataFrame(
        [("a", "t", "20240101000000"), ("a", "t", "20240101000000"), ("a", "u", "20240102000000"), ("b", "t", "20240103000000")],
        "app_name string, table_name string, batch_no string",
    )
    assert rows(processed_batches(status, "a", "t")) == [("20240101000000",)]
    listing = spark.createDataFrame([(f"2024010{d}000000",) for d in range(1, 5)] + [("x",)], "batchno string")
    assert rows(unprocessed_batches(listing, status, "a", "t")) == [(f"2024010{d}000000",) for d in (2, 3, 4)]
