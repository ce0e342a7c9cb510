"""Feeds derived by Spark from the driver's tables (no made-up rows).

- landing feed: ``events`` as CDC landing rows (key ``user_id``,
  ``current_ts`` = ts as text, ``pos`` = event_id as text, daily batch id)
- tax lines: ``orders`` as GST lines
- COD list: ``customer`` with an allow/block flag
- sync log: ``events`` as sync-status rows
- envelopes: ``events`` as API response bodies
- sessions / schedules: ``customer`` / ``nation`` + ``region``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.batch_ids import batch_id_of, epoch_seconds
from ..functions.columns import ColumnRule

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

FEED_KEYS = ["user_id"]
FEED_SELECT = ["user_id", "event_type", "value", "current_ts", "pos"]
FEED_RULES = [
    ColumnRule("row_key", "row_key", "user_id,kafka_ts"),
    ColumnRule("part_1", "part_1", "event_type"),
]
FEED_DATE_RULES = [
    ColumnRule("row_key", "row_key", "user_id,kafka_ts"),
    ColumnRule("part_1", "part_1", "kafka_ts"),
    ColumnRule("part_2", "part_2", "kafka_ts"),
    ColumnRule("part_3", "part_3", "kafka_ts"),
]

# Run times of the scripted runs (arguments, so reruns repeat).
BASE_RUN_TS = "2024-01-20 00:00:00"
DELTA_RUN_TS = "2024-01-22 00:00:00"
SECOND_RUN_TS = "2024-01-23 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landing_feed(spark: SparkSession, sf_dir: str, first_batch: str | None = None, last_batch: str | None = None) -> DataFrame:
    """events -> landing rows: user_id, event_type, value, current_ts, pos, batchno.

    With a daily batch range, the equivalent ``ts`` range is applied to the
    raw column first, so it reaches the parquet scan as a pushed filter (a
    real landing folder prunes by its ``batchno`` directories instead).
    """
    ev = table(spark, sf_dir, "events")
    if first_batch is not None:
        ev = ev.filter(F.col("ts") >= F.to_timestamp(F.lit(first_batch), "yyyyMMddHHmmss").cast("timestamp_ntz"))
    if last_batch is not None:
        upper = F.to_timestamp(F.lit(last_batch), "yyyyMMddHHmmss").cast("timestamp_ntz") + F.expr("interval 1 day")
        ev = ev.filter(F.col("ts") < upper)
    return ev.select(
        "user_id",
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.date_format("ts", TS_TEXT).alias("current_ts"),
        F.col("event_id").cast("string").alias("pos"),
        batch_id_of("ts", "day").alias("batchno"),
    )


def landing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> landing lines (value, batchno), some of them broken by their
    event_id modulo 50: 7 cut short, 13 a key of the wrong type, 21 a null
    key, 34 a value that is no number."""
    ev = table(spark, sf_dir, "events")
    kind = F.col("event_id") % 50
    user = F.coalesce(F.col("user_id").cast("string"), F.lit("null"))
    user = F.when(kind == 13, F.concat(F.lit('"x'), user, F.lit('"'))).when(kind == 21, "null").otherwise(user)
    amount = F.coalesce(F.col("value").cast("decimal(18,2)").cast("string"), F.lit("null"))
    line = F.concat(
        F.lit('{"user_id":'), user,
        F.lit(',"event_type":"'), F.col("event_type"),
        F.lit('","value":'), F.when(kind == 34, '"n/a"').otherwise(amount),
        F.lit(',"current_ts":"'), F.date_format("ts", TS_TEXT),
        F.lit('","pos":"'), F.col("event_id").cast("string"), F.lit('"}'),
    )
    return ev.select(F.when(kind == 7, F.substring(line, 1, 30)).otherwise(line).alias("value"), batch_id_of("ts", "day").alias("batchno"))


def drifting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> landing lines (value, batchno) whose field ``v`` is a whole
    number up to the 10th of the month, a number with two decimals up to the
    20th, and text after that; ``late`` comes with the text."""
    ev = table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    n = F.col("event_id")
    v = (
        F.when(day <= 10, n.cast("string"))
        .when(day <= 20, F.concat(n.cast("string"), F.lit(".25")))
        .otherwise(F.concat(F.lit('"n'), n.cast("string"), F.lit('","late":true')))
    )
    line = F.concat(F.lit('{"event_id":'), n.cast("string"), F.lit(',"v":'), v, F.lit("}"))
    return ev.select(line.alias("value"), batch_id_of("ts", "day").alias("batchno"))


def logged_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """app_status of runs that took the hourly batches of 02:00 on
    2024-01-05 and later up to 2024-01-25, but none of the hours 1 mod 3."""
    hours = table(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").alias("h")).distinct()
    taken = hours.filter(
        (F.col("h") >= F.lit("2024-01-05 02:00:00").cast("timestamp_ntz")) & (F.col("h") < F.lit("2024-01-25").cast("timestamp_ntz"))
        & (F.hour("h") % 3 != 1)
    )
    return taken.select(F.lit("events_app").alias("app_name"), F.lit("events").alias("table_name"), batch_id_of("h", "hour").alias("batch_no"))


def odd_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as snapshot rows (id, state, part_1) with partition values that
    need care: empty, null, an ampersand, an accent."""
    ev = table(spark, sf_dir, "events")
    part = (
        F.when(F.col("event_type") == "signup", "")
        .when(F.col("event_type") == "view", "R&D")
        .when(F.col("event_type") == "purchase", "éco")
        .when(F.col("event_type") == "error", "err")
    )
    return ev.select(F.col("event_id").cast("string").alias("id"), F.lit("old").alias("state"), part.alias("part_1"))


def hourly_batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing listing: one batch id per hour that has events."""
    ev = table(spark, sf_dir, "events")
    return ev.select(batch_id_of("ts", "hour").alias("batchno")).distinct()


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_SELECT = ["l_orderkey", "l_linenumber", "price", "l_returnflag", "current_ts", "pos"]
LINE_RULES = [
    ColumnRule("row_key", "row_key", "l_orderkey,l_linenumber"),
    ColumnRule("part_1", "part_1", "l_returnflag"),
]


def line_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as landing rows: time from the ship date, position from part
    and supplier (some keys of lineitem repeat, so the latest line counts)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), "l_returnflag",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("current_ts"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).cast("string").alias("pos"),
    )


def line_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of the lines of every tenth order: a new price, later positions."""
    feed = line_feed(spark, sf_dir).filter(F.col("l_orderkey") % 10 == 0)
    return feed.withColumns({
        "price": (F.col("price") + 1).cast("decimal(18,2)"),
        "pos": (F.col("pos").cast("bigint") + 10**15).cast("string"),
    })


def tax_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> gstin, gst_type, transaction_date, status (4 columns so the
    whole-row distinct has work to do)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("gstin"),
        F.col("o_orderpriority").alias("gst_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("transaction_date"),
        F.when(F.col("o_orderstatus") == "O", "VALID")
        .when(F.col("o_orderstatus") == "F", "ACTIVE")
        .when(F.col("o_orderstatus") == "P", "REJECTED")
        .alias("status"),
    )


def cod_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> CUST_ID, COD_ALLOWED (null for the AUTOMOBILE segment,
    1 for a non-negative balance, else 0)."""
    c = table(spark, sf_dir, "customer")
    flag = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("int"))
        .when(F.col("c_acctbal") >= 0, F.lit(1))
        .otherwise(F.lit(0))
    )
    return c.select(F.col("c_custkey").alias("CUST_ID"), flag.alias("COD_ALLOWED"))


def sync_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> raw_app_sync_status rows. batch_no is the epoch of the
    event's hour (a version id); signup -> file_sync, click ->
    partition_sync, error -> batch_deleted, other events are not logged."""
    ev = table(spark, sf_dir, "events")
    activity = (
        F.when(F.col("event_type") == "signup", "file_sync")
        .when(F.col("event_type") == "click", "partition_sync")
        .when(F.col("event_type") == "error", "batch_deleted")
    )
    return ev.select(
        F.lit("events_app").alias("app_name"),
        F.lit("events").alias("table_name"),
        epoch_seconds(F.date_trunc("hour", "ts")).cast("string").alias("batch_no"),
        activity.alias("activity_type"),
        F.col("ts").alias("event_ts"),
    ).filter(F.col("activity_type").isNotNull())


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions ``t`` present in a raw table: the epoch hour of every event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(epoch_seconds(F.date_trunc("hour", "ts")).alias("t")).distinct()


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> API response bodies (request_id, gstin, body):

    purchase: success with ``data`` (the props text); view: success without
    ``data``; error: error with a message; signup: error without message;
    click: a body cut short (malformed JSON).
    """
    ev = table(spark, sf_dir, "events")
    gstin = F.col("user_id").cast("string")
    ok_data = F.to_json(F.struct(F.lit("success").alias("status"), F.col("props").alias("data")))
    ok_nodata = F.to_json(F.struct(F.lit("success").alias("status")))
    err_msg = F.to_json(
        F.struct(F.lit("error").alias("status"), F.concat(F.lit("rate limit for "), gstin).alias("message"))
    )
    err_nomsg = F.to_json(F.struct(F.lit("error").alias("status")))
    cut = F.concat(F.lit('{"status": "success", "data": '), F.col("props"))
    body = (
        F.when(F.col("event_type") == "purchase", ok_data)
        .when(F.col("event_type") == "view", ok_nodata)
        .when(F.col("event_type") == "error", err_msg)
        .when(F.col("event_type") == "signup", err_nomsg)
        .otherwise(cut)
    )
    return ev.select(F.col("event_id").alias("request_id"), gstin.alias("gstin"), body.alias("body"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> a table of API responses (request_id, gstin, gst_type, fy,
    attempts, code, body): purchases, views and signups were answered (200),
    errors were refused by their id (429, 503, 404), of the clicks every
    fourth got no code and the others a server error."""
    ev = table(spark, sf_dir, "events")
    n = F.col("event_id")
    code = (
        F.when(F.col("event_type").isin("purchase", "view", "signup"), F.lit(200))
        .when(F.col("event_type") == "error", F.when(n % 3 == 0, 429).when(n % 3 == 1, 503).otherwise(404))
        .when(n % 4 != 0, F.lit(500))
    )
    told = ev.select(
        n.alias("request_id"),
        F.concat(F.lit("gstr"), (F.col("user_id") % 3).cast("string")).alias("gst_type"),
        F.when(F.col("user_id") % 2 == 0, "2023-24").otherwise("2024-25").alias("fy"),
        (n % 6 + 1).cast("int").alias("attempts"),
        code.alias("code"),
    )
    return envelopes(spark, sf_dir).join(told, "request_id")


def gst_status_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``gst_status`` of each type and year (gstin, gst_type, fy, status): a
    gstin that is VALID for one type is SUSPENDED for another."""
    s = gst_status(spark, sf_dir)
    kind = F.explode(F.array(*[F.lit(f"gstr{k}") for k in range(3)])).alias("gst_type")
    s = s.select("gstin", kind, "status").select("gstin", "gst_type", F.explode(F.array(F.lit("2023-24"), F.lit("2024-25"))).alias("fy"), "status")
    return s.withColumn("status", F.when((F.col("gst_type") == "gstr1") & (F.col("fy") == "2024-25"), F.lit("SUSPENDED")).otherwise(F.col("status")))


def gst_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> status file rows (gstin, status). Segments map to a
    status; customers of nation 0 get a second, ACTIVE row."""
    c = table(spark, sf_dir, "customer")
    status = (
        F.when(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), "VALID")
        .when(F.col("c_mktsegment") == "MACHINERY", "ACTIVE")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "CANCELLED")
        .otherwise("SUSPENDED")
    )
    first = c.select(F.col("c_custkey").cast("string").alias("gstin"), status.alias("status"))
    second = c.filter(F.col("c_nationkey") == 0).select(
        F.col("c_custkey").cast("string").alias("gstin"), F.lit("ACTIVE").alias("status")
    )
    return first.unionByName(second)


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> session rows with the 10 session-log columns."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    return c.select(
        F.col("c_name").alias("COMPANY1"),
        F.concat(F.lit("BP"), F.col("c_nationkey").cast("string")).alias("BUSSINESSPALCE1"),
        key.alias("GSTIN1"),
        F.lit("012024").alias("FP1"),
        F.col("c_mktsegment").alias("SECTION1"),
        F.concat(F.lit("user"), key).alias("USER1"),
        F.concat(F.lit("app"), key).alias("APPKEY"),
        F.concat(F.lit("sek"), key).alias("SEK"),
        F.concat(F.lit("tok"), key).alias("AUTHTOKEN"),
        F.col("c_acctbal").cast("string").alias("TEMP"),
    )


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation + region -> schedule rows: schedule_id = region name,
    gst_type = nation name, fy by nation parity, refresh settings."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.lower("n_name").alias("gst_type"),
        F.col("r_name").alias("schedule_id"),
        F.when(F.col("n_nationkey") % 2 == 0, "2023-24").otherwise("2024-25").alias("fy"),
        (F.col("n_nationkey") % 3 + 1).cast("string").alias("force_refresh_month"),
        F.lit("24").alias("refresh_timeout_hours"),
    )
