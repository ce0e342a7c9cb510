"""Schedules, request fan-out, fetch with retry, envelopes and the status
join (S14, S15, P12-P17, P19, X1, X5, U3, N20, N22-N24)."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# Fixed values that must equal the reference's.
MAX_RETRIES = 5
RATE_LIMIT_BACKOFF_MS = 2000
EXCEPTION_BACKOFF_MS = 1000
RETRY_CODES = (429, 503)
VALID_STATUSES = ("VALID", "ACTIVE")
NO_DATA_MESSAGE = "No data field in API response"
API_ERROR_PREFIX = "GST API error: "
UNKNOWN_ERROR = "Unknown error"
MALFORMED_MESSAGE = "Malformed API response"
REFRESH_MARKER = "gstr2a"


# ---------------------------------------------------------------- schedules


def expand_schedule(config: DataFrame, schedule_id: str) -> DataFrame:
    """One row per ``config.schedule`` entry of the run type
    (null or empty lists give no rows)."""
    items = config.select(
        F.col("config.rootpath").alias("rootpath"),
        F.col("config.datapath").alias("datapath"),
        F.col("config.statuspath").alias("statuspath"),
        F.col("config.sessionpath").alias("sessionpath"),
        F.explode(F.col("config.schedule")).alias("s"),
    )
    return items.select("rootpath", "datapath", "statuspath", "sessionpath", "s.*").filter(
        F.col("schedule_id") == schedule_id
    )


def request_url(base_url: str, gstin: Column, fy: Column, section: Column) -> Column:
    """Fetch URL of one request, parameters URL-encoded."""
    return F.concat(
        F.lit(base_url.rstrip("/") + "/fetch?gstin="),
        F.url_encode(gstin),
        F.lit("&fy="),
        F.url_encode(fy),
        F.lit("&section="),
        F.url_encode(section),
    )


def request_fanout(
    sessions: DataFrame,
    schedules: DataFrame,
    base_url: str,
    schedule_cols: Sequence[str] = ("gst_type", "fy"),
) -> DataFrame:
    """Each selected schedule x each session -> one request.

    The schedules are entries of one config document, which the driver reads
    anyway: they become an array literal that is exploded onto the sessions,
    so the session table is streamed once with no join at all.
    """
    entries = schedules.select(*schedule_cols).collect()
    sess = sessions.select(
        F.col("GSTIN1").cast("string").alias("gstin"), F.col("SECTION1").cast("string").alias("section")
    )
    if not entries:
        fan = sess.limit(0).select("gstin", "section", *[F.lit(None).cast("string").alias(c) for c in schedule_cols])
    else:
        arr = F.array(*[F.struct(*[F.lit(r[c]).cast("string").alias(c) for c in schedule_cols]) for r in entries])
        fan = sess.select("gstin", "section", F.explode(arr).alias("sch")).select(
            "gstin", "section", *[F.col(f"sch.{c}").alias(c) for c in schedule_cols]
        )
    return fan.withColumn("url", request_url(base_url, F.col("gstin"), F.col("fy"), F.col("section")))


# ---------------------------------------------------------------- fetch


FETCH_FIELDS = [
    StructField("attempts", IntegerType()),
    StructField("code", IntegerType()),
    StructField("body", StringType()),
    StructField("outcome", StringType()),
    StructField("error", StringType()),
]


def call_with_retry(
    fetch: Callable[[dict, int], tuple[int, str]],
    request: dict,
    max_retries: int = MAX_RETRIES,
    sleep: Callable[[float], None] | None = time.sleep,
) -> tuple[int, int | None, str | None, str, str | None]:
    """P12 for one request: (attempts, code, body, outcome, error).

    200 ok; 429/503 retried after 2 s x attempt; other 4xx fail; other
    codes fail; an exception is retried after 1 s x attempt. At most
    ``max_retries`` retries, so ``max_retries + 1`` calls.
    """
    attempt = 0
    while True:
        try:
            code, body = fetch(request, attempt)
        except Exception as e:  # noqa: BLE001 - the outcome is data
            if attempt < max_retries:
                if sleep:
                    sleep(EXCEPTION_BACKOFF_MS * (attempt + 1) / 1000)
                attempt += 1
                continue
            return attempt + 1, None, None, "exception", f"{type(e).__name__}: {e}"
        code = int(code)
        if code == 200:
            return attempt + 1, code, body, "ok", None
        if code in RETRY_CODES:
            if attempt < max_retries:
                if sleep:
                    sleep(RATE_LIMIT_BACKOFF_MS * (attempt + 1) / 1000)
                attempt += 1
                continue
            return attempt + 1, code, body, "rate_limited", f"still refused as too frequent after {max_retries} repeats"
        if 400 <= code < 500:
            return attempt + 1, code, body, "client_error", f"request rejected ({code}): {body}"
        return attempt + 1, code, body, "server_error", f"server failed ({code})"


def _spread(df: DataFrame, num_partitions: int | None, key_cols: Sequence[str]) -> DataFrame:
    """Hash-partition a request table on its key (deterministic on retry)
    so latency-bound calls run on many executors, not in one task."""
    if num_partitions is None:
        return df
    return df.repartition(num_partitions, *[F.col(c) for c in key_cols])


def map_calls(items: list, call: Callable, concurrency: int) -> list:
    """Run ``call`` over ``items`` keeping order; I/O-bound calls may use a
    small thread pool inside the task."""
    if concurrency <= 1 or len(items) <= 1:
        return [call(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        return list(pool.map(call, items))


def fetch_table(
    requests: DataFrame,
    fetch: Callable[[dict, int], tuple[int, str]],
    max_retries: int = MAX_RETRIES,
    backoff: bool = True,
    request_cols: Sequence[str] | None = None,
    num_partitions: int | None = None,
    concurrency: int = 1,
) -> DataFrame:
    """The response table of a request table. Calls and retries
    run on the executors (``mapInPandas``); every request gets one row
    with its attempt count, last code and body, outcome and error text.
    ``num_partitions`` spreads the requests by key first; ``concurrency``
    overlaps calls inside a task."""
    from ..runtime import ship_package

    ship_package(requests.sparkSession)
    cols = list(request_cols or requests.columns)
    out_schema = StructType(requests.schema.fields + FETCH_FIELDS)
    sleeper = time.sleep if backoff else None

    def one(vals):
        return call_with_retry(fetch, dict(zip(cols, vals)), max_retries, sleeper)

    def run(batches):
        for pdf in batches:
            res = map_calls(list(zip(*[pdf[c] for c in cols])), one, concurrency)
            yield pdf.assign(
                attempts=[r[0] for r in res],
                code=[r[1] for r in res],
                body=[r[2] for r in res],
                outcome=[r[3] for r in res],
                error=[r[4] for r in res],
            )

    return _spread(requests, num_partitions, cols).mapInPandas(run, out_schema)


def api_metrics(responses: DataFrame) -> DataFrame:
    """Calls (attempts), successful and failed requests."""
    return responses.agg(
        F.sum("attempts").cast("bigint").alias("api_calls"),
        F.sum(F.when(F.col("outcome") == "ok", 1).otherwise(0)).cast("bigint").alias("api_success"),
        F.sum(F.when(F.col("outcome") != "ok", 1).otherwise(0)).cast("bigint").alias("api_failure"),
    )


# ---------------------------------------------------------------- envelopes

ENVELOPE_SCHEMA = StructType(
    [
        StructField("status", StringType()),
        StructField("message", StringType()),
        StructField("data", StringType()),
        StructField("_corrupt", StringType()),
    ]
)


def parse_envelope(responses: DataFrame, body_col: str = "body") -> DataFrame:
    """Split ``{status, message, data}`` bodies into ``data``
    (JSON text, for ``status = success`` with a data field) or ``error``.
    A nested object or array in ``data`` is kept as its JSON text."""
    env = F.from_json(F.col(body_col), ENVELOPE_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt"})
    # A filter on ``ok`` is pushed below this projection with the parse
    # inlined; codegen's subexpression elimination still parses each body
    # once (measured: faster than forcing one parse through a generator).
    df = responses.withColumn("_env", env)
    malformed = F.col("_env").isNull() | F.col("_env._corrupt").isNotNull()
    success = F.col("_env.status") == "success"
    error = (
        F.when(malformed, F.lit(MALFORMED_MESSAGE))
        .when(success & F.col("_env.data").isNull(), F.lit(NO_DATA_MESSAGE))
        .when(~success | F.col("_env.status").isNull(), F.concat(F.lit(API_ERROR_PREFIX), F.coalesce(F.col("_env.message"), F.lit(UNKNOWN_ERROR))))
    )
    return (
        df.withColumn("error", error)
        .withColumn("ok", F.col("error").isNull())
        .withColumn("data", F.when(F.col("error").isNull(), F.col("_env.data")))
        .drop("_env")
    )


def _data_rows(data_schema: StructType | str) -> Column:
    """``data`` as an array of payload rows: a JSON array gives its elements,
    a lone object one; null when it does not parse."""
    if isinstance(data_schema, str):
        data_schema = StructType.fromDDL(data_schema)
    marked = StructType([*data_schema.fields, StructField("_bad", StringType())])
    options = {"columnNameOfCorruptRecord": "_bad"}
    rows = F.from_json(F.col("data"), ArrayType(marked), options)
    return F.when(~F.exists(rows, lambda r: r.isNull() | r["_bad"].isNotNull()), rows)


def parse_data(parsed: DataFrame, data_schema: StructType | str, keep: Sequence[str]) -> DataFrame:
    """Payload rows of the successful envelopes, ``data`` parsed by
    schema: one row per element of an array, one for an object. A payload
    field named like a kept request column is left out. Data that does not
    parse gives no row here and one in ``data_failures``."""
    ok = parsed.filter(F.col("ok")).select(*keep, F.explode(_data_rows(data_schema)).alias("_d"))
    fields = [n for n in ok.select("_d.*").columns if n not in set(keep) and n != "_bad"]
    return ok.select(*keep, *[F.col(f"_d.`{n}`").alias(n) for n in fields])


def data_failures(parsed: DataFrame, data_schema: StructType | str) -> DataFrame:
    """The successful envelopes whose ``data`` does not parse, as envelope
    rows that are not ok."""
    bad = parsed.filter(F.col("ok") & _data_rows(data_schema).isNull())
    return bad.withColumn("ok", F.lit(False)).withColumn("error", F.lit(MALFORMED_MESSAGE))


def union_payloads(frames: Sequence[DataFrame]) -> DataFrame:
    """One table from frames parsed with different schemas (by name,
    missing columns as null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def failed_actions(responses: DataFrame, run_ts: str, key_col: str = "gstin", id_col: str = "request_id") -> DataFrame:
    """Failures as retry actions (action_id, timestamp, action_type, data):
    API_CALL_ERROR for failed calls, API_PARSE_ERROR for bad envelopes."""
    call_failed = F.col("outcome").isNotNull() & (F.col("outcome") != "ok") if "outcome" in responses.columns else F.lit(False)
    parse_failed = (~F.col("ok")) if "ok" in responses.columns else F.lit(False)
    kind = F.when(call_failed, F.lit("API_CALL_ERROR")).when(parse_failed, F.lit("API_PARSE_ERROR"))
    return (
        responses.withColumn("action_type", kind)
        .filter(F.col("action_type").isNotNull())
        .select(
            F.concat(F.lower(F.col("action_type")), F.lit("_"), F.col(id_col).cast("string")).alias("action_id"),
            F.lit(run_ts).alias("timestamp"),
            "action_type",
            F.col(key_col).cast("string").alias("data"),
        )
    )


# ---------------------------------------------------------------- status join


def valid_records(
    api: DataFrame, status: DataFrame, key: str | Sequence[str] = "gstin", status_from: str = "auto"
) -> DataFrame:
    """API rows with a matching status row whose status is
    VALID or ACTIVE; a row repeats once per matching status row. ``key`` names
    the join columns: (gstin, gst_type, fy) where one status table holds the
    files of several schedules (M1).

    ``status_from``: 'left' (the API frame's own status), 'right' (the
    status file's), or 'auto' = left when the API frame has one (D7).
    The filter is pushed below the join to the side it reads.
    """
    keys = [key] if isinstance(key, str) else list(key)
    use_left = status_from == "left" or (status_from == "auto" and "status" in api.columns)
    a, s = api.alias("a"), status.alias("s")
    if use_left:
        a = a.filter(F.col("status").isin(*VALID_STATUSES)).alias("a")
        s = s.select(*keys).alias("s")
    else:
        s = s.filter(F.col("status").isin(*VALID_STATUSES)).select(*keys).alias("s")
    cond = reduce(lambda x, y: x & y, [F.col(f"a.{k}") == F.col(f"s.{k}") for k in keys])
    return a.join(s, cond, "inner").select("a.*")


def fetch_summary(valid: DataFrame, process_date: str, fetched: DataFrame | None = None) -> DataFrame:
    """P11 (fetch): valid records per (gst_type, financial year); with the
    ``fetched`` requests (gst_type, fy), types without valid records too (0)."""
    pair = ["gst_type", "financial_year"]
    counts = valid.groupBy("gst_type", F.col("fy").alias("financial_year")).agg(F.count(F.lit(1)).cast("bigint").alias("record_count"))
    if fetched is not None:
        asked = fetched.select("gst_type", F.col("fy").alias("financial_year")).distinct().alias("a")
        cond = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"c.{c}")) for c in pair])
        counts = asked.join(counts.alias("c"), cond, "left").select(
            *[F.col(f"a.{c}").alias(c) for c in pair], F.coalesce("c.record_count", F.lit(0).cast("bigint")).alias("record_count")
        )
    return counts.withColumn("process_date", F.lit(process_date))


# ---------------------------------------------------------------- calendar


def refresh_profile(path: Column, day: Column) -> Column:
    """P16: '24hr' on the 12th/13th, '1day' on Saturday/Sunday, for paths
    containing the refresh marker; 'default' otherwise. First match wins."""
    marked = path.contains(REFRESH_MARKER)
    return (
        F.when(marked & F.dayofmonth(day).isin(12, 13), F.lit("24hr"))
        .when(marked & F.dayofweek(day).isin(7, 1), F.lit("1day"))
        .otherwise(F.lit("default"))
    )


def month_list(day: Column, n_months: Column, drop_first: Column) -> Column:
    """The last ``n`` month starts up to the month of ``day``;
    without the oldest one when ``drop_first`` (24-hour mode)."""
    last = F.trunc(day, "MM")
    first = F.add_months(last, -(n_months - 1))
    months = F.when(n_months > 0, F.sequence(F.least(first, last), last, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))
    return F.when(drop_first, F.slice(months, 2, F.greatest(n_months - 1, F.lit(0)))).otherwise(months)
