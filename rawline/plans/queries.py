"""Driver queries: name -> fn(spark, sf_dir) -> DataFrame.

Each one runs a rawline operator over a whole table of ``sf_dir`` (or a
feed Spark derives from it). The matching DuckDB SQL is in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.batch_ids import epoch_seconds, is_valid_batch_id
from ..functions.columns import as_date, cast_all, clean_key, prefix3
from ..operators.audit import app_status_rows, sync_rows
from ..operators import batches
from ..operators.checks import column_check
from ..operators.batches import (
    batch_predicate, extract_mark, incremental_filter, mark_value, processed_batches, select_batches, substitute_mark, unprocessed_batches,
)
from ..operators.dedupe import latest_in_delta
from ..operators.publish import (
    BATCH_DELETED,
    FILE_SYNC,
    pending_with_decision,
    retention_candidates,
    sync_mark,
)
from ..operators import scd
from ..operators.scd import (
    apply_merge,
    prepare_delta,
    prepare_landing,
    scd1_merge,
    touched_partitions,
)
from ..operators import external as ext
from ..operators import flat as flt
from ..operators import responses as rsp
from ..config import rule_table
from ..runtime import cut_lineage, materialize, scratch_path
from ..sinks.files import export_by_type as write_by_type
from ..sinks import key_files as kf
from ..sinks import manifest as mf
from ..sinks.files import (
    append_csv, append_table, count_rows, publish_partitions, register_new_partitions, registered_partitions, write_json_by, write_key_index, write_partitioned,
)
from ..sinks.tables import bucket_count, create_bucketed_snapshot
from ..sources.files import read_csv, read_sessions
from ..sources.landing import list_batches, list_versions, merged_schema, read_landing, read_lines, read_snapshot, stage_landing
from . import feeds as fd

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    REGISTRY[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- SCD runs

BASE_BATCHES = ("20240101000000", "20240119000000")
DELTA_BATCHES = ("20240120000000", "20991231000000")  # all later batches
ALL_BATCHES = (BASE_BATCHES[0], DELTA_BATCHES[1])


def snapshot_before(spark: SparkSession, sf_dir: str, last_batch: str, rules=fd.FEED_RULES, date=False) -> DataFrame:
    """The published snapshot after one initial run over batches up to
    ``last_batch`` (built with the same merge pipeline)."""
    feed = fd.landing_feed(spark, sf_dir, BASE_BATCHES[0], last_batch).filter(
        batch_predicate("batchno", BASE_BATCHES[0], last_batch)
    )
    return prepare_delta(feed, fd.FEED_KEYS, fd.FEED_SELECT, rules, fd.BASE_RUN_TS, date_partitioned=date)


def delta_of(spark: SparkSession, sf_dir: str, start: str, end: str, types=None, rules=fd.FEED_RULES, date=False, run_ts=fd.DELTA_RUN_TS) -> DataFrame:
    feed = fd.landing_feed(spark, sf_dir, start, end).filter(batch_predicate("batchno", start, end))
    if types is not None:
        feed = feed.filter(F.col("event_type").isin(list(types)))
    return prepare_delta(feed, fd.FEED_KEYS, fd.FEED_SELECT, rules, run_ts, date_partitioned=date)


def delta_once(spark: SparkSession, sf_dir: str, *args, **more) -> DataFrame:
    """``delta_of``, run once: a merge reads it for its touched partitions and for its rows."""
    return materialize(delta_of(spark, sf_dir, *args, **more), "delta")


@query
def latest_in_delta_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + F1 + J4: latest landing row per key in the delta batches."""
    feed = fd.landing_feed(spark, sf_dir, *ALL_BATCHES).filter(batch_predicate("batchno", *ALL_BATCHES))
    return latest_in_delta(prepare_landing(feed, fd.FEED_SELECT, fd.DELTA_RUN_TS), fd.FEED_KEYS)


@query
def scd1_merge_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship P1: all event types in the delta, so every partition is touched."""
    base = snapshot_before(spark, sf_dir, BASE_BATCHES[1])
    delta = delta_once(spark, sf_dir, *DELTA_BATCHES)
    return scd1_merge(delta, base, fd.FEED_KEYS, ["part_1"])


@query
def scd1_merge_untouched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + F4: only click/view in the delta; other partitions are left out."""
    base = snapshot_before(spark, sf_dir, BASE_BATCHES[1])
    delta = delta_once(spark, sf_dir, *DELTA_BATCHES, types=("click", "view"))
    return scd1_merge(delta, base, fd.FEED_KEYS, ["part_1"])


@query
def scd1_merge_lexicographic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 with positions compared as text, as the reference's W2 does."""
    base = snapshot_before(spark, sf_dir, BASE_BATCHES[1])
    delta = delta_once(spark, sf_dir, *DELTA_BATCHES)
    return scd1_merge(delta, base, fd.FEED_KEYS, ["part_1"], lexicographic=True)


@query
def scd1_merge_global_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 with the whole snapshot taking part (D2 off): one row per key."""
    base = snapshot_before(spark, sf_dir, BASE_BATCHES[1])
    delta = delta_once(spark, sf_dir, *DELTA_BATCHES, types=("click", "view"))
    return scd1_merge(delta, base, fd.FEED_KEYS, ["part_1"], global_keys=True)


INDEX_BUCKETS = 8


@query
def scd1_merge_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 with keys that move partition, by the key index beside the snapshot:
    the whole snapshot afterwards, one row per key."""
    root, index_path = scratch_path(spark, "R_indexed"), scratch_path(spark, "R_index")
    write_partitioned(snapshot_before(spark, sf_dir, BASE_BATCHES[1]), root, ["part_1"], mode="overwrite")
    base = read_snapshot(spark, root, _ddl(spark, SNAPSHOT_SCHEMA))
    write_key_index(scd.key_index(base, fd.FEED_KEYS, ["part_1"], INDEX_BUCKETS), index_path)
    index = spark.read.schema(f"user_id string, part_1 string, {scd.BUCKET_COL} int").orc(index_path)
    delta = delta_once(spark, sf_dir, *DELTA_BATCHES, types=("click", "view"))
    merged, rewritten = scd.scd1_merge_indexed(delta, base, index, fd.FEED_KEYS, ["part_1"], INDEX_BUCKETS)
    return apply_merge(base, merged, rewritten, ["part_1"])


FILE_ROWS = 1000


@query
def scd1_merge_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1/F4 inside a partition: only the files that hold a key of the delta
    are read and rewritten; the whole snapshot afterwards, by its manifest."""
    root = scratch_path(spark, "R_files")
    base = snapshot_before(spark, sf_dir, BASE_BATCHES[1])
    kf.start_key_snapshot(base, root, 1705708800, fd.FEED_KEYS, ["part_1"], FILE_ROWS)
    delta = delta_of(spark, sf_dir, *DELTA_BATCHES, types=("click", "view"))
    kf.merge_key_files(delta, root, 1705881600, fd.FEED_KEYS, ["part_1"], rows_per_file=FILE_ROWS)
    return kf.read_key_snapshot(spark, root, delta.schema)


def _line_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_delta(fd.line_feed(spark, sf_dir), fd.LINE_KEYS, fd.LINE_SELECT, fd.LINE_RULES, fd.BASE_RUN_TS)


@query
def scd1_merge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 on a big table: every tenth order's lines of lineitem are updated;
    key of two columns, partition by return flag."""
    delta = materialize(prepare_delta(fd.line_updates(spark, sf_dir), fd.LINE_KEYS, fd.LINE_SELECT, fd.LINE_RULES, fd.DELTA_RUN_TS), "delta")
    return scd1_merge(delta, _line_snapshot(spark, sf_dir), fd.LINE_KEYS, ["part_1"])


DATE_PARTS = ["part_1", "part_2", "part_3"]


@query
def scd1_multi_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 on a date-partitioned table (part_1 year, part_2 month, part_3
    date of kafka_ts). The delta replays batch 2024-01-20, already in the
    snapshot: replayed rows tie with the snapshot and the snapshot row stays."""
    base = snapshot_before(spark, sf_dir, "20240120000000", fd.FEED_DATE_RULES, date=True)
    delta = delta_once(spark, sf_dir, *DELTA_BATCHES, rules=fd.FEED_DATE_RULES, date=True)
    return scd1_merge(delta, base, fd.FEED_KEYS, DATE_PARTS)


@query
def scd1_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 run twice with a publish in between; the whole snapshot after run 2,
    which replays the first run's batch and takes all later ones."""
    snap0 = materialize(snapshot_before(spark, sf_dir, BASE_BATCHES[1]), "snapshot")
    d1 = delta_once(spark, sf_dir, "20240120000000", "20240120000000", types=("click", "view"))
    snap1 = apply_merge(snap0, scd1_merge(d1, snap0, fd.FEED_KEYS, ["part_1"]), touched_partitions(d1, ["part_1"]), ["part_1"])
    snap1 = materialize(snap1, "snapshot")  # the published snapshot between the runs
    d2 = delta_once(spark, sf_dir, *DELTA_BATCHES, run_ts=fd.SECOND_RUN_TS)
    return apply_merge(snap1, scd1_merge(d2, snap1, fd.FEED_KEYS, ["part_1"]), touched_partitions(d2, ["part_1"]), ["part_1"])


@query
def cast_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of events to text, nulls kept."""
    return cast_all(fd.table(spark, sf_dir, "events"), "string")


def _landing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_all(prepare_landing(fd.landing_feed(spark, sf_dir), fd.FEED_SELECT, fd.DELTA_RUN_TS))


@query
def row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10a over every landing row."""
    df = _landing_text(spark, sf_dir)
    return df.select("trail_file_pos", clean_key(["user_id", "kafka_ts"]).alias("row_key"))


@query
def part_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10b over every landing row."""
    df = _landing_text(spark, sf_dir)
    return df.select("trail_file_pos", prefix3("event_type").alias("part_1"))


@query
def part_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10c-e over every landing row."""
    df = _landing_text(spark, sf_dir)
    return df.select(
        "trail_file_pos",
        F.year(as_date("kafka_ts")).alias("part_1"),
        F.month(as_date("kafka_ts")).alias("part_2"),
        as_date("kafka_ts").alias("part_3"),
    )


@query
def touched_partitions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: distinct partition of the flagship delta."""
    return touched_partitions(delta_of(spark, sf_dir, *ALL_BATCHES), ["part_1"])


@query
def touched_partitions_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (year, month, date) of a date-partitioned delta."""
    delta = delta_of(spark, sf_dir, *ALL_BATCHES, rules=fd.FEED_DATE_RULES, date=True)
    return touched_partitions(delta, DATE_PARTS)


@query
def batches_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed range of landing batches."""
    return select_batches(fd.hourly_batch_ids(spark, sf_dir), "batchno", "20240110000000", "20240112230000")


@query
def batches_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open range (start only)."""
    return select_batches(fd.hourly_batch_ids(spark, sf_dir), "batchno", "20240125000000")


def _previous_app_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """app_status of an earlier run that took the daily batches up to 01-19."""
    daily = fd.landing_feed(spark, sf_dir).select("batchno").distinct()
    done = select_batches(daily, "batchno", *BASE_BATCHES)
    return app_status_rows(done, "events_app", "events", fd.BASE_RUN_TS, fd.BASE_RUN_TS, 0)


@query
def batches_after_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No start given, so batches after the last logged one."""
    mark = mark_value(_previous_app_status(spark, sf_dir), "events_app", "events")
    return select_batches(fd.hourly_batch_ids(spark, sf_dir), "batchno", mark=mark)


@query
def batch_id_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F17/F18 over batch-id candidates derived from events: day taken
    from user_id (00-39), 13 digits for clicks, a letter for errors."""
    ev = fd.table(spark, sf_dir, "events")
    day = F.lpad((F.col("user_id") % 40).cast("string"), 2, "0")
    c14 = F.concat(F.date_format("ts", "yyyyMM"), day, F.date_format("ts", "HHmmss"))
    cand = (
        F.when(F.col("event_type") == "click", F.substring(c14, 1, 13))
        .when(F.col("event_type") == "error", F.concat(F.substring(c14, 1, 13), F.lit("x")))
        .otherwise(c14)
    )
    return ev.select("event_id", cand.alias("candidate")).withColumn("is_valid", is_valid_batch_id("candidate"))


SYNC_CUTOFF = "2024-01-29 00:00:00"


def _sync_log_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fd.sync_log(spark, sf_dir).filter(F.col("event_ts") < F.lit(SYNC_CUTOFF).cast("timestamp_ntz"))


@query
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: max published version per activity type of the sync log."""
    return batches.high_water_mark(fd.sync_log(spark, sf_dir), "events_app", "events", by=["activity_type"])


@query
def pending_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions newer than the last file_sync, with the action."""
    mark = sync_mark(_sync_log_before(spark, sf_dir), "events_app", "events")
    return pending_with_decision(fd.versions(spark, sf_dir), mark)


@query
def retention_candidates_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3/F12/F15/P3 over the whole sync log."""
    return retention_candidates(fd.sync_log(spark, sf_dir), "events_app", "events")


@query
def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: one app_status row per delta batch, with the merge's row count."""
    merged = scd1_merge_q(spark, sf_dir)
    n = merged.count()
    daily = fd.landing_feed(spark, sf_dir).select("batchno").distinct()
    taken = select_batches(daily, "batchno", *DELTA_BATCHES)
    return app_status_rows(taken, "events_app", "events", fd.DELTA_RUN_TS, fd.SECOND_RUN_TS, n)


@query
def sync_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: file_sync rows for pending versions, batch_deleted rows for
    retention candidates (one frame each, unioned)."""
    mark = sync_mark(_sync_log_before(spark, sf_dir), "events_app", "events")
    pend = pending_with_decision(fd.versions(spark, sf_dir), mark)
    synced = sync_rows(pend, "events_app", "events", FILE_SYNC, fd.DELTA_RUN_TS, F.col("n_pending"))
    cand = retention_candidates(fd.sync_log(spark, sf_dir), "events_app", "events")
    deleted = sync_rows(cand, "events_app", "events", BATCH_DELETED, fd.SECOND_RUN_TS, None, batch_col="batch_no")
    return synced.unionByName(deleted)


@query
def incremental_filter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after a validated from-date (typed, pushed to the scan)."""
    mark = extract_mark("19990101000000", None, "orders_app", "orders")
    return incremental_filter(fd.table(spark, sf_dir, "orders"), "o_orderdate", mark)


# ---------------------------------------------------------------- COD push

ENV = "PRD"
RUN_BATCH = "20240122000000"
RECORD_DATE = "2024-01-22"


def _cod_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext.flag_split(fd.cod_list(spark, sf_dir))


@query
def flag_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """allow/block split of the COD list."""
    return _cod_split(spark, sf_dir)


@query
def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and requests of 700 per operation."""
    return ext.chunk_counts(_cod_split(spark, sf_dir))


@query
def request_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of 700 ids in id order."""
    return ext.request_batches(_cod_split(spark, sf_dir), size=700)


@query
def request_batches_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 with 50 ids per request (many chunks)."""
    return ext.request_batches(_cod_split(spark, sf_dir), size=50)


def _pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload with a response per request, as a column expression of it:
    a request whose first id is 3 mod 4 was refused."""
    payload = ext.number_requests(ext.request_batches(_cod_split(spark, sf_dir), size=50))
    first = F.col("first_id")
    refused = F.concat(F.lit('{"error": "rejected", "op": "'), "operation", F.lit('", "first": '), first.cast("string"), F.lit("}"))
    code = F.when(first % 4 != 3, 200).when(F.col("operation") == "block", 500).otherwise(404)
    return payload.withColumns({"code": code, "body": F.when(code == 200, F.lit("{}")).otherwise(refused), "error": F.lit(None).cast("string")})


@query
def route_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows of accepted requests."""
    return ext.route_status(_pushed(spark, sf_dir), "cod_app", ENV, RECORD_DATE, RUN_BATCH)


@query
def route_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error rows of rejected requests, body parsed."""
    return ext.route_errors(_pushed(spark, sf_dir), RECORD_DATE, RUN_BATCH, "error string, op string, first bigint")


# ---------------------------------------------------------------- flat files

RUN_DATE = "2024-01-22"


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flt.flat_transform(fd.tax_lines(spark, sf_dir), RUN_DATE)


@query
def flat_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9/N5-N7/F3/A6 on orders as tax lines."""
    return _flat(spark, sf_dir)


@query
def flat_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per exported type."""
    return flt.type_counts(_flat(spark, sf_dir))


@query
def flat_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run summary row."""
    return flt.flat_summary(_flat(spark, sf_dir), "gstr1", RUN_DATE)


FLAT_READ_SCHEMA = (
    "gstin string, transaction_date string, status string, load_timestamp string, "
    "process_date date, month int, year int, gstin_hash string, gst_type string"
)


@query
def export_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9/P10: one CSV per type in one job, read back with its schema."""
    out = scratch_path(spark, "flat")
    write_by_type(_flat(spark, sf_dir), out)
    return read_csv(spark, out, FLAT_READ_SCHEMA, header=True)


# ---------------------------------------------------------------- envelopes


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rsp.parse_envelope(fd.envelopes(spark, sf_dir))


@query
def parse_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every response body split into data or error."""
    return _parsed(spark, sf_dir).select("request_id", "gstin", "ok", "error", "data")


@query
def envelope_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successful envelopes with their data parsed by schema."""
    return rsp.parse_data(_parsed(spark, sf_dir), "k int", ["request_id", "gstin"])


@query
def envelope_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed envelopes as retry actions (API_PARSE_ERROR)."""
    return rsp.failed_actions(_parsed(spark, sf_dir), RUN_DATE)


@query
def union_payload_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of two shapes in one table, by name: what the API answered
    successfully, and an answer with another shape for every event."""
    a = rsp.parse_data(_parsed(spark, sf_dir), "k int", ["request_id", "gstin"])
    data = F.to_json(F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("value").alias("v")))
    body = F.to_json(F.struct(F.lit("success").alias("status"), data.alias("data")))
    ev = fd.table(spark, sf_dir, "events")
    answers = ev.select(F.col("event_id").alias("request_id"), F.col("user_id").cast("string").alias("gstin"), body.alias("body"))
    return rsp.union_payloads([a, rsp.parse_data(rsp.parse_envelope(answers), "k int, v double", ["request_id", "gstin"])])


def _api_rows(spark: SparkSession, sf_dir: str, with_status: bool) -> DataFrame:
    api = rsp.parse_data(_parsed(spark, sf_dir), "k int", ["request_id", "gstin"])
    if with_status:
        api = api.withColumn("status", F.when(F.col("k") >= 50, "VALID").otherwise("EXPIRED"))
    return api


@query
def valid_records_left_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The API rows carry their own status."""
    return rsp.valid_records(_api_rows(spark, sf_dir, True), fd.gst_status(spark, sf_dir), status_from="left")


@query
def valid_records_right_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status comes from the status file."""
    return rsp.valid_records(_api_rows(spark, sf_dir, False), fd.gst_status(spark, sf_dir), status_from="right")


BASE_URL = "http://api.test"
SCHEDULE_ID = "ASIA"


@query
def schedule_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The config document's nested schedule, one row per entry
    of the run type."""
    entries = fd.schedules(spark, sf_dir)
    paths = [F.lit(v).alias(c) for c, v in (("rootpath", "/gst"), ("datapath", "data/"), ("statuspath", "status/"), ("sessionpath", "session/"))]
    nested = entries.agg(F.collect_list(F.struct(*entries.columns)).alias("schedule"))
    return rsp.expand_schedule(nested.select(F.struct(*paths, "schedule").alias("config")), SCHEDULE_ID)


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    sched = schedule_expand(spark, sf_dir)
    return rsp.request_fanout(fd.sessions(spark, sf_dir), sched, BASE_URL)


@query
def request_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every session x every schedule of the run type."""
    return _requests(spark, sf_dir)


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fd.responses(spark, sf_dir).withColumn("outcome", ext.outcome_of("code"))


@query
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16: attempts, last code and outcome class per response."""
    return _fetched(spark, sf_dir).select("request_id", "gstin", "gst_type", "fy", "attempts", "code", "outcome")


@query
def api_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls, successes and failures of a response table."""
    return rsp.api_metrics(_fetched(spark, sf_dir))


def _typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = rsp.parse_envelope(_fetched(spark, sf_dir).filter(F.col("outcome") == "ok"))
    return rsp.parse_data(parsed, "k int", ["request_id", "gstin", "gst_type", "fy"])


@query
def valid_records_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status matched on (gstin, gst_type, fy)."""
    return rsp.valid_records(_typed_rows(spark, sf_dir), fd.gst_status_by_type(spark, sf_dir), ["gstin", "gst_type", "fy"])


@query
def gst_valid_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13->P14->P11: envelopes parsed, kept against the status table,
    counted per (gst_type, financial year), types without valid rows too."""
    valid = rsp.valid_records(_typed_rows(spark, sf_dir), fd.gst_status_by_type(spark, sf_dir), ["gstin", "gst_type", "fy"])
    return rsp.fetch_summary(valid, RUN_DATE, _fetched(spark, sf_dir))


@query
def json_by_type_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: valid records as JSON by (gst_type, fy), read back."""
    valid = valid_records_by_type(spark, sf_dir)
    out = scratch_path(spark, "gst_json")
    write_json_by(valid, out, ["gst_type", "fy"])
    return spark.read.schema(valid.schema).json(out)


@query
def catalog_audit_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows appended twice to a catalog table, read back."""
    import uuid

    name = f"audit_{uuid.uuid4().hex[:12]}"
    told = audit_rows(spark, sf_dir)
    append_table(told, name)
    append_table(told.withColumn("record_count", F.lit(0).cast("bigint")), name)
    back = cut_lineage(spark.table(name))
    spark.sql(f"DROP TABLE {name}")
    return back


def _array_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes whose data is an array of two objects (purchases), a lone
    object (views), cut short (clicks) or an empty array."""
    ev = fd.table(spark, sf_dir, "events")
    p = F.col("props")
    data = (
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("["), p, F.lit(', {"k": -1}]')))
        .when(F.col("event_type") == "view", p)
        .when(F.col("event_type") == "click", F.concat(F.lit("["), p))
        .otherwise(F.lit("[]"))
    )
    body = F.to_json(F.struct(F.lit("success").alias("status"), data.alias("data")))
    env = ev.select(F.col("event_id").alias("request_id"), F.col("user_id").cast("string").alias("gstin"), body.alias("body"))
    return rsp.parse_envelope(env)


@query
def envelope_array_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per element of an array payload, one per object."""
    return rsp.parse_data(_array_envelopes(spark, sf_dir), "k int", ["request_id", "gstin"])


@query
def parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that do not parse, as retry actions."""
    bad = rsp.data_failures(_array_envelopes(spark, sf_dir), "k int")
    return rsp.failed_actions(bad, RUN_DATE)


# ---------------------------------------------------------------- calendar


def _event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fd.table(spark, sf_dir, "events")
    path = F.concat(F.lit("/data/"), F.when(F.col("user_id") % 2 == 0, "gstr2a").otherwise("gstr1"), F.lit("/"))
    return ev.select("event_id", path.alias("path"), F.to_date("ts").alias("day"))


@query
def refresh_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P16/N22 for every event: profile, day of month, weekday."""
    d = _event_days(spark, sf_dir)
    return d.select(
        "event_id",
        rsp.refresh_profile(F.col("path"), F.col("day")).alias("profile"),
        F.dayofmonth("day").alias("day_of_month"),
        F.dayofweek("day").alias("day_of_week"),
        F.date_format("day", "EEEE").alias("weekday"),
    )


@query
def month_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last 3 months per distinct event day and path; the oldest
    month dropped in 24-hour mode."""
    d = _event_days(spark, sf_dir).select("path", "day").distinct()
    prof = rsp.refresh_profile(F.col("path"), F.col("day"))
    months = rsp.month_list(F.col("day"), F.lit(3), prof == "24hr")
    return d.select("path", "day", F.explode(months).alias("month_start"))


# ---------------------------------------------------------------- round trips

LANDING_SCHEMA = "user_id bigint, event_type string, value decimal(18,2), current_ts string, pos string"


@query
def landing_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the feed as landing JSON by batch, list the batch
    folders, select a closed range and read the chosen folders at once."""
    root = scratch_path(spark, "L_events")
    write_partitioned(fd.landing_feed(spark, sf_dir), root, ["batchno"], fmt="json", mode="overwrite", files_per_partition=1)
    listing = list_batches(spark, root)
    chosen = [r["batchno"] for r in select_batches(listing, "batchno", *ALL_BATCHES).collect()]
    return read_landing(spark, root, _ddl(spark, LANDING_SCHEMA), chosen)


def _ddl(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


SNAPSHOT_SCHEMA = (
    "user_id string, event_type string, value string, kafka_ts string, trail_file_pos string, "
    "last_updated_date string, row_key string, part_1 string"
)


@query
def orc_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot in ORC (t=0), merge of a click/view delta
    written as version t=<epoch>, published into t=0 by dynamic overwrite,
    snapshot read back with declared partition types."""
    root = scratch_path(spark, "R_events")
    snap_path = f"{root}/t=0"
    write_partitioned(snapshot_before(spark, sf_dir, BASE_BATCHES[1]), snap_path, ["part_1"], mode="overwrite")
    schema = _ddl(spark, SNAPSHOT_SCHEMA)
    base = read_snapshot(spark, snap_path, schema)
    delta = delta_of(spark, sf_dir, *DELTA_BATCHES, types=("click", "view"))
    touched = touched_partitions(delta, ["part_1"])
    version_path = f"{root}/t=1705881600"
    write_partitioned(scd1_merge(delta, base, fd.FEED_KEYS, ["part_1"]), version_path, ["part_1"], mode="overwrite")
    publish_partitions(read_snapshot(spark, version_path, schema), snap_path, ["part_1"], touched)
    return read_snapshot(spark, snap_path, schema)


@query
def scd1_merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 against a snapshot kept as a catalog table bucketed by key (one
    bucket per shuffle partition): the click/view delta is merged with the
    touched partitions read bucket by bucket, with no shuffle of the
    snapshot and none for W2."""
    import uuid

    name = f"raw_events_{uuid.uuid4().hex[:12]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    snap = snapshot_before(spark, sf_dir, BASE_BATCHES[1])
    create_bucketed_snapshot(snap, name, fd.FEED_KEYS, ["part_1"], n, scratch_path(spark, name))
    delta = delta_of(spark, sf_dir, *DELTA_BATCHES, types=("click", "view"))
    merged = cut_lineage(scd1_merge(delta, spark.table(name), fd.FEED_KEYS, ["part_1"], buckets=bucket_count(spark, name)))
    spark.sql(f"DROP TABLE {name}")
    return merged


@query
def csv_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions appended as headerless CSV, read back with a
    declared schema and named by position."""
    out = scratch_path(spark, "sessions")
    fd.sessions(spark, sf_dir).write.mode("append").option("header", False).csv(out)
    return read_sessions(spark, out)


# ---------------------------------------------------------------- landing in full


def _landing_folder(spark: SparkSession, lines: DataFrame) -> tuple[str, list[str]]:
    """Lines (value, batchno) as a landing folder, and its batches."""
    root = scratch_path(spark, "L_lines")
    lines.write.partitionBy("batchno").text(root)
    return root, sorted(r["batchno"] for r in list_batches(spark, root).collect())


@query
def landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder with broken lines; good rows with their columns,
    quarantined lines with their reason: together, all lines there are."""
    root, batches_ = _landing_folder(spark, fd.landing_lines(spark, sf_dir))
    staged = stage_landing(spark, root, _ddl(spark, LANDING_SCHEMA), batches_, fd.FEED_KEYS)
    return staged.good.unionByName(staged.quarantined, allowMissingColumns=True)


@query
def landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/P5: lines read, merged and quarantined, counted from committed files."""
    root, batches_ = _landing_folder(spark, fd.landing_lines(spark, sf_dir))
    staged = stage_landing(spark, root, _ddl(spark, LANDING_SCHEMA), batches_, fd.FEED_KEYS)
    lines = read_lines(spark, root, batches_).agg(F.count(F.lit(1)).alias("n_lines"))
    return lines.select("n_lines", F.lit(staged.n_good).cast("bigint").alias("n_good"), F.lit(staged.n_quarantined).cast("bigint").alias("n_quarantined"))


@query
def landing_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches in which a field goes from integer to decimal to text,
    read at once with the schema that they all fit."""
    root, batches_ = _landing_folder(spark, fd.drifting_lines(spark, sf_dir))
    return read_landing(spark, root, merged_schema(spark, root, batches_), batches_).select("event_id", "v", "late", "batchno")


@query
def batches_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that no run has logged, those below the mark included."""
    return unprocessed_batches(fd.hourly_batch_ids(spark, sf_dir), fd.logged_batches(spark, sf_dir), "events_app", "events")


@query
def batches_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of an app and table."""
    return processed_batches(fd.logged_batches(spark, sf_dir), "events_app", "events")


# ---------------------------------------------------------------- publishing


def _two_versions(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, DataFrame]:
    """A raw table with two versions, each merged over the one before, and the
    partitions that the second one touched."""
    root = scratch_path(spark, "R_events")
    schema = _ddl(spark, SNAPSHOT_SCHEMA)
    write_partitioned(snapshot_before(spark, sf_dir, BASE_BATCHES[1]), f"{root}/t=1705708800", ["part_1"], mode="overwrite")
    base = read_snapshot(spark, f"{root}/t=1705708800", schema)
    delta = delta_once(spark, sf_dir, *DELTA_BATCHES, types=("click", "view"))
    write_partitioned(scd1_merge(delta, base, fd.FEED_KEYS, ["part_1"]), f"{root}/t=1705881600", ["part_1"], mode="overwrite")
    return root, base, touched_partitions(delta, ["part_1"])


def _published(spark: SparkSession, sf_dir: str) -> str:
    """A raw table whose two versions were published by the manifest's pointer."""
    root, _, touched = _two_versions(spark, sf_dir)
    for number, (version, of) in enumerate(((1705708800, None), (1705881600, touched)), 1):
        rows = read_snapshot(spark, f"{root}/t={version}", _ddl(spark, SNAPSHOT_SCHEMA))
        mf.write_manifest(mf.next_manifest(spark, root, ["part_1"], rows, f"t={version}", of), root, number)
        mf.switch_pointer(spark, root, mf.Pointer(number, version, count_rows(rows)))
    return root


@query
def publish_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot read through the manifest; no row was copied."""
    return mf.read_published(spark, _published(spark, sf_dir), _ddl(spark, SNAPSHOT_SCHEMA), ["part_1"])


@query
def publish_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot after going back to the first manifest."""
    root = _published(spark, sf_dir)
    mf.roll_back(spark, root, 1)
    return mf.read_published(spark, root, _ddl(spark, SNAPSHOT_SCHEMA), ["part_1"])


@query
def manifest_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which version holds each live partition, after retention
    deleted what no manifest names; rows from the folders that are left."""
    root = _published(spark, sf_dir)
    mf.retire(spark, root, ["part_1"], ["t=1705708800", "t=1705881600"])
    left = spark.read.schema("t bigint, part_1 string").option("basePath", root).orc([f"{root}/t=1705708800", f"{root}/t=1705881600"])
    return left.groupBy("t", "part_1").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def publish_emptied_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version that rewrites the empty, null and ``R&D`` partitions
    and empties ``éco``, published into the snapshot; ``err`` is untouched."""
    root = scratch_path(spark, "R_odd")
    snap = fd.odd_partitions(spark, sf_dir)
    write_partitioned(snap, root, ["part_1"], mode="overwrite")
    moved = snap.filter(F.col("part_1").isNull() | F.col("part_1").isin("", "R&D")).filter(F.col("id").cast("bigint") % 2 == 0)
    version = materialize(moved.withColumn("state", F.lit("new")), "version")
    publish_partitions(version, root, ["part_1"], [(None,), ("",), ("R&D",), ("éco",)])
    return spark.read.schema("id string, state string, part_1 string").orc(root)


@query
def version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/K3: rows of each version, from its committed files."""
    root, _, _ = _two_versions(spark, sf_dir)
    t = list_versions(spark, root)
    rows = spark.read.schema("t bigint, part_1 string").option("basePath", root).orc([f"{root}/t={r['t']}" for r in t.collect()])
    return rows.groupBy("t").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def versions_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions written as folders, found again by listing."""
    root = scratch_path(spark, "R_versions")
    ev = fd.table(spark, sf_dir, "events")
    of = ev.select(epoch_seconds(F.date_trunc("day", "ts")).alias("t"), "event_id")
    write_partitioned(of, root, ["t"], mode="overwrite")
    return list_versions(spark, root)


@query
def partitions_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's partition list after two runs wrote partitions
    outside it (odd values included) and one partition went away."""
    import uuid

    root, name = scratch_path(spark, "R_listed"), f"listed_{uuid.uuid4().hex[:12]}"
    snap = fd.odd_partitions(spark, sf_dir)
    spark.sql(f"CREATE TABLE {name} (id string, state string, part_1 string) USING orc PARTITIONED BY (part_1) LOCATION '{root}'")
    write_partitioned(snap.filter(F.col("part_1").isin("err", "éco")), root, ["part_1"])
    register_new_partitions(spark, name, ["part_1"], root)
    write_partitioned(snap.filter(F.col("part_1").isNull() | F.col("part_1").isin("", "R&D")), root, ["part_1"])
    publish_partitions(snap.filter("part_1 = 'err'"), root, ["part_1"], [("err",), ("éco",)])  # empties éco
    register_new_partitions(spark, name, ["part_1"], root)
    listed = registered_partitions(spark, name, ["part_1"])
    there = cut_lineage(spark.table(name).groupBy("part_1").agg(F.count(F.lit(1)).alias("n_rows")))
    spark.sql(f"DROP TABLE {name}")
    return listed.join(there, listed["part_1"].eqNullSafe(there["part_1"])).select(listed["part_1"], "n_rows")


# ---------------------------------------------------------------- configs and checks


@query
def rule_table_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3/N13/J10f/S6: the rule list of a config document (nation + region as
    its entries; one without a key, one without a name per region)."""
    n, r = fd.table(spark, sf_dir, "nation"), fd.table(spark, sf_dir, "region")
    k = F.col("n_nationkey") % 7
    rule = F.struct(
        F.when(k != 3, F.lower("r_name")).alias("columnkey"), F.when(k != 5, F.lower("n_name")).alias("columnname"),
        F.when(k != 1, F.col("n_nationkey").cast("string")).alias("columnformula"),
    )
    doc = n.join(r, n.n_regionkey == r.r_regionkey).groupBy().agg(F.collect_list(rule).alias("additional_columns"))
    return rule_table(doc.select(F.struct("additional_columns").alias("rawpipeline")))


@query
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the required session columns of a session list that lacks one."""
    return column_check(fd.sessions(spark, sf_dir).drop("USER1"))


@query
def substitute_mark_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source query with the last run's mark in place of its
    placeholder, run on the source."""
    text = "select o_orderkey, o_orderdate from {orders} where o_orderdate > to_timestamp('dummy_date', 'yyyyMMddHHmmss')"
    status = fd.table(spark, sf_dir, "orders").select(
        F.lit("orders_app").alias("app_name"), F.lit("orders").alias("table_name"),
        F.date_format(F.date_trunc("year", "o_orderdate"), "yyyyMMddHHmmss").alias("batch_no"),
    )
    mark = extract_mark(None, status.distinct(), "orders_app", "orders")
    return spark.sql(substitute_mark(text, mark), orders=fd.table(spark, sf_dir, "orders"))


@query
def summary_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: two runs' summary rows appended as CSV with a header, read back."""
    out = scratch_path(spark, "summary")
    for section in ("gstr1", "gstr2a"):
        append_csv(flt.flat_summary(_flat(spark, sf_dir), section, RUN_DATE), out, header=True)
    return read_csv(spark, out, "section string, process_date string, record_count bigint, file_count bigint, error_count bigint, status string", header=True)


@query
def resume_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests of a repeated run, without the ids that the failed
    run before it got accepted."""
    sent = _pushed(spark, sf_dir)
    ledger = sent.withColumn("batch_no", F.lit(RUN_BATCH))
    return ext.request_batches(ext.without_accepted(_cod_split(spark, sf_dir), ledger, None), size=50)


QUERY_NAMES = {
    "substitute_mark_q": "substitute_mark",
    "latest_in_delta_q": "latest_in_delta",
    "scd1_merge_q": "scd1_merge",
    "touched_partitions_q": "touched_partitions",
    "retention_candidates_q": "retention_candidates",
    "sync_rows_q": "sync_rows",
    "incremental_filter_q": "incremental_filter",
}


def queries() -> dict[str, QueryFn]:
    return {QUERY_NAMES.get(k, k): v for k, v in REGISTRY.items()}
