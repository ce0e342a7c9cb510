"""Flag split, request batching, push and response routing (F2, P7, A8,
L6, N17, K10, P8, F16, N8).

Ids never go to the driver: the payload is a table with one row per API
request (operation, batch_index, id_list), numbered exactly like
``row_number() over (partition by operation order by id)`` but without
putting an operation into one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..runtime import cut_lineage, ship_package

# Fixed values that must equal the reference's.
BATCH_SIZE = 700
ALLOW, BLOCK = "allow", "block"
OPERATIONS = (ALLOW, BLOCK)


def flag_split(df: DataFrame, flag_col: str = "COD_ALLOWED", op_col: str = "operation") -> DataFrame:
    """1 -> allow, 0 -> block; null and other values go to neither."""
    op = F.when(F.col(flag_col) == 1, F.lit(ALLOW)).when(F.col(flag_col) == 0, F.lit(BLOCK))
    return df.withColumn(op_col, op).filter(F.col(op_col).isNotNull())


def number_within(
    df: DataFrame,
    group_col: str,
    order_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact 1-based ``_rn`` per group in ``order_col`` order, in two passes.

    1. range-partition on (group, order) and sort inside partitions; a
       partition-local index comes from ``monotonically_increasing_id``;
       the result is checkpointed so the indexes are stable on retry;
    2. count rows per (partition, group), prefix-sum the counts over the
       partitions of each group (a table of at most groups + partitions
       rows) and add the offset back.
    A group spread over many partitions is numbered by many tasks.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = df.repartitionByRange(n, F.col(group_col), F.col(order_col)).sortWithinPartitions(group_col, order_col)
    s = s.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    s = cut_lineage(s)
    stats = s.groupBy("_pid", group_col).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.partitionBy(group_col).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    stats = cut_lineage(stats.select("_pid", group_col, "_off", "_m0"))
    # a null group is a group; AQE picks the join by the measured size
    stats = stats.select(F.col("_pid").alias("_p"), F.col(group_col).alias("_g"), "_off", "_m0")
    out = s.join(stats, (F.col("_pid") == F.col("_p")) & F.col(group_col).eqNullSafe(F.col("_g"))).drop("_p", "_g")
    rn = F.col("_off") + (F.col("_mid") - F.col("_m0")) + F.lit(1)
    return out.withColumn("_rn", rn.cast("bigint")).drop("_pid", "_mid", "_off", "_m0")


def request_batches(
    df: DataFrame,
    id_col: str = "CUST_ID",
    op_col: str = "operation",
    size: int = BATCH_SIZE,
    num_partitions: int | None = None,
) -> DataFrame:
    """One row per request: operation, batch_index (0-based),
    n_ids, first_id, last_id, id_list (ids in order, comma-joined).
    Each group of the final aggregate holds at most ``size`` ids. A null id
    names nothing to send: it is left out of numbers, counts and lists."""
    ids = df.select(op_col, id_col).filter(F.col(id_col).isNotNull())
    numbered = number_within(ids, op_col, id_col, num_partitions)
    numbered = numbered.withColumn("batch_index", F.floor((F.col("_rn") - 1) / F.lit(size)).cast("bigint"))
    ids = F.sort_array(F.collect_list(F.col(id_col))).cast("array<string>")
    return numbered.groupBy(op_col, "batch_index").agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.min(id_col).alias("first_id"),
        F.max(id_col).alias("last_id"),
        F.concat_ws(",", ids).alias("id_list"),
    )


def chunk_counts(df: DataFrame, op_col: str = "operation", size: int = BATCH_SIZE) -> DataFrame:
    """Ids and requests per operation, ``ceil(n / size)``."""
    return df.groupBy(op_col).agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("bigint").alias("n_batches"),
    )


def number_requests(payload: DataFrame, op_col: str = "operation", size: int = BATCH_SIZE) -> DataFrame:
    """Global request sequence: allow requests first, then block, each in
    batch order, plus the operation's total id count (D11). The per-op
    totals are at most one row per operation."""
    totals = payload.groupBy(op_col).agg(F.sum("n_ids").alias("op_total"), F.count(F.lit(1)).alias("n_req"))
    rows = {r[op_col]: (r["op_total"], r["n_req"]) for r in totals.collect()}
    ordered = [op for op in OPERATIONS if op in rows] + sorted(op for op in rows if op not in OPERATIONS)
    offset, offs = 0, {}
    for op in ordered:
        offs[op] = offset
        offset += rows[op][1]
    off_col = F.lit(0)
    total_col = F.lit(0)
    for op in ordered:
        off_col = F.when(F.col(op_col) == op, F.lit(offs[op])).otherwise(off_col)
        total_col = F.when(F.col(op_col) == op, F.lit(rows[op][0])).otherwise(total_col)
    return payload.withColumn("request_seq", (off_col + F.col("batch_index") + 1).cast("bigint")).withColumn(
        "op_total", total_col.cast("bigint")
    )


RESPONSE_FIELDS = [StructField("code", IntegerType()), StructField("body", StringType()), StructField("error", StringType())]


def push_requests(
    payload: DataFrame,
    client: Callable[[dict], tuple[int, str]],
    param_names: tuple[str, str] = ("param1", "param2"),
    key_param: str | None = None,
    run_batch: str | None = None,
    num_partitions: int | None = None,
    concurrency: int = 1,
) -> DataFrame:
    """Call the API once per payload row on the executors
    (``mapInPandas``, Arrow batches). ``client(params)`` returns (code,
    body) and may raise; the exception text is kept in ``error``.

    With ``key_param`` each call also sends the request's deterministic key
    (run batch + sequence), so a receiver can drop repeats when a task is
    retried after an executor loss. ``num_partitions`` spreads requests by
    key over tasks; ``concurrency`` overlaps calls inside a task.
    """
    from .responses import map_calls

    ship_package(payload.sparkSession)
    out_schema = StructType(payload.schema.fields + RESPONSE_FIELDS)
    p1, p2 = param_names
    if key_param is not None and (run_batch is None or "request_seq" not in payload.columns):
        raise ValueError("key_param needs run_batch and a numbered payload (number_requests)")

    def one(item):
        ids, op, seq = item
        params = {p1: ids, p2: op}
        if key_param is not None:
            params[key_param] = f"{run_batch}{int(seq):06d}"
        try:
            code, body = client(params)
            return int(code), body, None
        except Exception as e:  # noqa: BLE001 - recorded, not raised
            return None, None, f"{type(e).__name__}: {e}"

    def run(batches):
        for pdf in batches:
            seqs = pdf["request_seq"] if key_param is not None else [None] * len(pdf)
            res = map_calls(list(zip(pdf["id_list"], pdf["operation"], seqs)), one, concurrency)
            yield pdf.assign(code=[r[0] for r in res], body=[r[1] for r in res], error=[r[2] for r in res])

    if num_partitions is not None:
        payload = payload.repartition(num_partitions, F.col("operation"), F.col("batch_index"))
    return payload.mapInPandas(run, out_schema)


#: Every request that was sent, with its answer, by run.
LEDGER_DDL = (
    "operation string, batch_index bigint, request_seq bigint, op_total bigint, n_ids bigint, id_list string, "
    "code int, body string, error string, batch_no string"
)


def accepted_ids(ledger: DataFrame, mark: str | None, op_col: str = "operation") -> DataFrame:
    """(id, operation) last accepted for each id by runs after ``mark`` (the
    last run that went through): what failed runs got done."""
    ok = ledger.filter(F.col("code") == 200)
    if mark is not None:
        ok = ok.filter(F.col("batch_no") > F.lit(mark))
    each = ok.select(F.explode(F.split("id_list", ",")).alias("id"), op_col, F.struct("batch_no", "request_seq").alias("_at"))
    return each.groupBy("id").agg(F.max_by(op_col, "_at").alias(op_col))


def without_accepted(
    split: DataFrame, ledger: DataFrame, mark: str | None, id_col: str = "CUST_ID", op_col: str = "operation"
) -> DataFrame:
    """P8/K5 resumed: rows whose id a failed run has not brought into this
    operation yet. Ids, not requests, are compared: the extract of the repeated
    run may hold more rows, so its requests hold other ids."""
    done = accepted_ids(ledger, mark, op_col).select(F.col("id").alias("_id"), F.col(op_col).alias("_op"))
    same = (F.col(id_col).cast("string") == F.col("_id")) & (F.col(op_col) == F.col("_op"))
    return split.join(done, same, "left_anti")


def outcome_of(code: str = "code") -> F.Column:
    """F16: class of an HTTP code."""
    c = F.col(code)
    return (
        F.when(c.isNull(), F.lit("exception"))
        .when(c == 200, F.lit("ok"))
        .when(c.isin(429, 503), F.lit("rate_limited"))
        .when((c >= 400) & (c < 500), F.lit("client_error"))
        .otherwise(F.lit("server_error"))
    )


def _request_no(run_batch: str) -> F.Column:
    """The pushed request key as a column: six digits at least, never cut."""
    seq = F.col("request_seq").cast("string")
    return F.concat(F.lit(run_batch), F.lpad(seq, F.greatest(F.length(seq), F.lit(6)), F.lit("0")))


def route_status(responses: DataFrame, app_name: str, env: str, record_date: str, run_batch: str) -> DataFrame:
    """P8, code 200: status rows. ``record_count`` = ``success_count`` =
    the operation's total (as the reference writes, D11), and
    ``batch_record_count`` the request's own ids."""
    ok = responses.filter(F.col("code") == 200)
    request_no = _request_no(run_batch)
    counter = F.lit(1)
    return ok.select(
        F.lit(app_name).alias("app_name"),
        F.concat(request_no, counter.cast("string"), F.lit("1")).alias("request_key"),
        F.col("op_total").cast("bigint").alias("record_count"),
        request_no.alias("request_no"),
        counter.alias("request_counter"),
        F.col("op_total").cast("bigint").alias("success_count"),
        F.concat(F.lit(f"env:{env} & op:"), F.col("operation")).alias("status"),
        F.lit(record_date).cast("date").alias("status_record_date_dt"),
        F.lit(run_batch).alias("batch_no"),
        F.col("n_ids").cast("bigint").alias("batch_record_count"),
    )


def route_errors(responses: DataFrame, record_date: str, run_batch: str, body_schema: StructType | str) -> DataFrame:
    """P8, other codes: error rows, the raw body kept next to its parsed
    fields (a body that is not JSON gives null fields)."""
    bad = responses.filter(F.col("code").isNull() | (F.col("code") != 200))
    parsed = F.from_json(F.col("body"), body_schema)
    return bad.select(
        "request_seq",
        "operation",
        F.col("code"),
        outcome_of("code").alias("outcome"),
        F.coalesce(F.col("body"), F.col("error")).alias("body"),
        parsed.alias("parsed"),
        F.lit(record_date).cast("date").alias("part_record_date_dt"),
        F.lit(run_batch).alias("batch_no"),
    ).select("*", "parsed.*").drop("parsed")
