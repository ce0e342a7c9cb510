from conftest import rows
from pyspark.sql import functions as F

from rawline.operators import responses as rsp
from rawline.runtime import ship_package


def script(codes):
    def fetch(request, attempt):
        c = codes[min(attempt, len(codes) - 1)]
        if c == "exc":
            raise TimeoutError("slow")
        return c, f"body{attempt}"

    return fetch


def test_retry_outcomes():
    call = lambda codes: rsp.call_with_retry(script(codes), {}, sleep=None)
    assert call([200]) == (1, 200, "body0", "ok", None)
    assert call([429, 200])[:4] == (2, 200, "body1", "ok")
    r = call([503] * 6)
    assert r[0] == 6 and r[3] == "rate_limited" and "5 repeats" in r[4]
    assert call([404])[3:] == ("client_error", "request rejected (404): body0")
    assert call([500])[3:] == ("server_error", "server failed (500)")
    r = call(["exc"])
    assert r[0] == 6 and r[3] == "exception" and r[4].startswith("TimeoutError")
    assert call(["exc", 200])[:4] == (2, 200, "body1", "ok")


def test_retry_backoff_schedule():
    waits = []
    rsp.call_with_retry(script([429, 503, "exc", 200]), {}, sleep=waits.append)
    assert waits == [2.0, 4.0, 3.0]


def test_fetch_table_and_metrics(spark):
    ship_package(spark)
    req = spark.createDataFrame([("1",), ("2",), ("3",)], "gstin string")

    def fetch(request, attempt):
        g = request["gstin"]
        if g == "1":
            return 200, "{}"
        if g == "2":
            return (429, "") if attempt < 2 else (200, "{}")
        return 404, "nope"

    out = rsp.fetch_table(req, fetch, backoff=False)
    assert rows(out, "gstin", "attempts", "outcome") == [("1", 1, "ok"), ("2", 3, "ok"), ("3", 1, "client_error")]
    m = rsp.api_metrics(out).first()
    assert (m["api_calls"], m["api_success"], m["api_failure"]) == (5, 2, 1)


def test_envelope_cases(spark):
    bodies = [
        (1, '{"status": "success", "data": "{\\"k\\": 1}"}'),
        (2, '{"status": "success"}'),
        (3, '{"status": "error", "message": "quota"}'),
        (4, '{"status": "error"}'),
        (5, '{"status": "success", "data": '),
        (6, '{"status": "success", "data": [1, 2]}'),
        (7, '{"status": "success", "data": {"k": 7}}'),
    ]
    df = spark.createDataFrame(bodies, "request_id int, body string")
    got = {r["request_id"]: (r["ok"], r["error"], r["data"]) for r in rsp.parse_envelope(df).collect()}
    assert got[1] == (True, None, '{"k": 1}')
    assert got[2] == (False, "No data field in API response", None)
    assert got[3] == (False, "GST API error: quota", None)
    assert got[4] == (False, "GST API error: Unknown error", None)
    assert got[5] == (False, "Malformed API response", None)
    assert got[6] == (True, None, "[1,2]")
    assert got[7][0] and got[7][2].replace(" ", "") == '{"k":7}'
    parsed = rsp.parse_data(rsp.parse_envelope(df), "k int", ["request_id"])
    assert rows(parsed.filter("request_id in (1, 7)")) == [(1, 1), (7, 7)]


def test_status_join_cases(spark):
    api = spark.createDataFrame(
        [("g1", 1, "VALID"), ("g2", 2, "VALID"), ("g3", 3, "EXPIRED"), ("g4", 4, "ACTIVE")],
        "gstin string, amt int, status string",
    )
    st = spark.createDataFrame(
        [("g1", "ACTIVE"), ("g1", "CANCELLED"), ("g3", "VALID"), ("g4", "VALID"), ("g9", "VALID")],
        "gstin string, status string",
    )
    # left status: g1 twice (two status rows), g2 no match, g3 not valid on the left
    assert rows(rsp.valid_records(api, st), "gstin") == [("g1",), ("g1",), ("g4",)]
    # right status: g1 once (only ACTIVE row), g3 valid on the right
    right = rsp.valid_records(api.drop("status"), st)
    assert rows(right, "gstin") == [("g1",), ("g3",), ("g4",)]
    assert rows(rsp.valid_records(api, st, status_from="right"), "gstin") == [("g1",), ("g3",), ("g4",)]


def test_fanout_and_schedule(spark):
    cfg = spark.createDataFrame(
        [
            (
                {
                    "rootpath": "/r",
                    "datapath": "d/",
                    "statuspath": "s/",
                    "sessionpath": "x/",
                    "schedule": [
                        {"gst_type": "gstr1", "schedule_id": "daily", "fy": "2023-24"},
                        {"gst_type": "gstr2a", "schedule_id": "daily", "fy": "2024-25"},
                        {"gst_type": "gstr3", "schedule_id": "weekly", "fy": "2024-25"},
                    ],
                },
            )
        ],
        "config struct<rootpath string, datapath string, statuspath string, sessionpath string, "
        "schedule array<struct<gst_type string, schedule_id string, fy string>>>",
    )
    sched = rsp.expand_schedule(cfg, "daily")
    assert rows(sched, "gst_type") == [("gstr1",), ("gstr2a",)]
    sessions = spark.createDataFrame([("G 1", "B2B"), ("G2", "B2C")], "GSTIN1 string, SECTION1 string")
    out = rsp.request_fanout(sessions, sched, "http://h/")
    assert out.count() == 4
    assert "http://h/fetch?gstin=G+1&fy=2023-24&section=B2B" in [r["url"] for r in out.collect()]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_calendar(spark):
    import datetime as dt

    df = spark.createDataFrame(
        [("/x/gstr2a/", dt.date(2024, 1, 12)), ("/x/gstr2a/", dt.date(2024, 1, 13)), ("/x/gstr2a/", dt.date(2024, 1, 14)),
         ("/x/gstr2a/", dt.date(2024, 1, 15)), ("/x/gstr1/", dt.date(2024, 1, 13))],
        "path string, day date",
    )
    prof = [r[0] for r in df.select(rsp.refresh_profile(F.col("path"), F.col("day"))).collect()]
    assert prof == ["24hr", "24hr", "1day", "default", "default"]
    m = df.select(rsp.month_list(F.col("day"), F.lit(3), F.lit(False)).alias("m")).first()["m"]
    assert m == [dt.date(2023, 11, 1), dt.date(2023, 12, 1), dt.date(2024, 1, 1)]
    m2 = df.select(rsp.month_list(F.col("day"), F.lit(3), F.lit(True)).alias("m")).first()["m"]
    assert m2 == [dt.date(2023, 12, 1), dt.date(2024, 1, 1)]


def test_map_calls_keeps_order_with_threads():
    import time as _t

    def slow(x):
        _t.sleep(0.01 * (5 - x % 5))
        return x * 2

    assert rsp.map_calls(list(range(20)), slow, 8) == [x * 2 for x in range(20)]
    assert rsp.map_calls([3], slow, 8) == [6]


def test_fetch_table_spread_and_concurrency(spark):
    ship_package(spark)
    req = spark.createDataFrame([(str(i),) for i in range(40)], "gstin string").coalesce(1)
    out = rsp.fetch_table(req, lambda r, a: (200, r["gstin"]), backoff=False, num_partitions=4, concurrency=4)
    assert out.rdd.getNumPartitions() == 4
    assert sorted(r["body"] for r in out.collect()) == sorted(str(i) for i in range(40))


def test_fanout_of_many_schedules_is_exact(spark):
    """Every session meets every schedule once, in one pass with no join. A
    third of the sessions are copies of one row (a hot group)."""
    sched = spark.createDataFrame([(f"t{i}", "2024-25" if i % 2 else "2023-24") for i in range(300)] + [(None, "2024-25")], "gst_type string, fy string")
    ses = [(f"G{i}", "B2B" if i % 3 else None) for i in range(10)] + [("HOT", "B2B")] * 5
    out = rsp.request_fanout(spark.createDataFrame(ses, "GSTIN1 string, SECTION1 string"), sched, "http://h/")
    assert out.count() == 15 * 301
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_array_payloads_and_status_by_type(spark):
    env = [("r1", '{"status": "success", "data": [{"k": 1}, {"k": 2}]}'), ("r2", '{"status": "success", "data": {"k": 3}}'),
           ("r3", '{"status": "success", "data": "[]"}'), ("r4", '{"status": "success", "data": "[{"}'), ("r5", '{"status": "success", "data": "text"}')]
    parsed = rsp.parse_envelope(spark.createDataFrame(env, "request_id string, body string"))
    assert rows(rsp.parse_data(parsed, "k int", ["request_id"])) == [("r1", 1), ("r1", 2), ("r2", 3)]
    assert rows(rsp.data_failures(parsed, "k int"), "request_id") == [("r4",), ("r5",)]
    api = spark.createDataFrame([("g", "t1", "y", 1), ("g", "t2", "y", 2)], "gstin string, gst_type string, fy string, n int")
    st = spark.createDataFrame([("g", "t1", "y", "VALID"), ("g", "t2", "y", "CANCELLED"), ("g", "t2", "z", "VALID")], "gstin string, gst_type string, fy string, status string")
    assert rows(rsp.valid_records(api, st, ["gstin", "gst_type", "fy"]), "n") == [(1,)]
