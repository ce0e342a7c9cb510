"""End-to-end jobs: the reference's pipelines as compositions of the
operators. Each job takes its run time as an argument, reads and writes
only through Spark, and keeps driver work to metadata (batch names,
version numbers, counts from ``observe``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import ExternalConfig, RawPipelineConfig
from ..functions.columns import partition_columns, partition_types
from ..operators import external as ext
from ..operators import flat as flt
from ..operators import responses as rsp
from ..operators.audit import APP_STATUS_COLS, SYNC_STATUS_COLS, app_status_rows, sync_rows
from ..operators.batches import mark_value, select_batches, unprocessed_batches
from ..operators.dedupe import latest_per_key
from ..operators.publish import BATCH_DELETED, FILE_SYNC, publish_decision, retention_candidates, sync_mark
from ..operators.scd import POS_COL, TS_COL, prepare_delta, restrict_to_touched, scd1_merge, touched_partitions
from ..functions.columns import position_order
from ..sinks import manifest as mf
from ..sinks.files import (
    append_csv, count_rows, delete_path, list_children, path_exists, publish_partitions, register_new_partitions, write_json_by, write_partitioned,
    write_quarantine,
)
from ..runtime import cut_lineage, input_bytes, materialize, size_shuffle_partitions
from ..sources.landing import landing_dir, list_batches, list_versions, merged_schema, quarantine_dir, raw_dir, read_snapshot, sample_schema, stage_landing

APP_STATUS_DDL = (
    "app_name string, table_name string, batch_no string, process_start_time timestamp_ntz, "
    "process_end_time timestamp_ntz, record_count bigint"
)
SYNC_STATUS_DDL = (
    "app_name string, table_name string, batch_no string, activity_type string, file_sync_time timestamp_ntz, "
    "partition_sync_time timestamp_ntz, file_delete_time timestamp_ntz, record_count bigint"
)


@dataclass
class AuditStore:
    """Audit tables kept as ORC folders."""

    app_status_path: str
    sync_status_path: str

    def app_status(self, spark: SparkSession) -> DataFrame:
        return _read_or_empty(spark, self.app_status_path, APP_STATUS_DDL)

    def sync_status(self, spark: SparkSession) -> DataFrame:
        return _read_or_empty(spark, self.sync_status_path, SYNC_STATUS_DDL)

    def append_app_status(self, df: DataFrame) -> None:
        df.select(*APP_STATUS_COLS).coalesce(1).write.mode("append").orc(self.app_status_path)

    def append_sync_status(self, df: DataFrame) -> None:
        df.select(*SYNC_STATUS_COLS).coalesce(1).write.mode("append").orc(self.sync_status_path)


@dataclass
class CatalogAuditStore(AuditStore):
    """Audit tables kept as catalog tables (S11/K4): read with
    ``spark.table``, appended with ``insertInto``; created on first use as
    ORC tables at the given locations."""

    app_status_table: str = "raw_app_status"
    sync_status_table: str = "raw_app_sync_status"

    def _table(self, spark: SparkSession, name: str, ddl: str, path: str) -> DataFrame:
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(name, path=path, source="orc", schema=spark.createDataFrame([], ddl).schema)
        return spark.table(name)

    def app_status(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, self.app_status_table, APP_STATUS_DDL, self.app_status_path)

    def sync_status(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, self.sync_status_table, SYNC_STATUS_DDL, self.sync_status_path)

    def append_app_status(self, df: DataFrame) -> None:
        self.app_status(df.sparkSession)
        df.select(*APP_STATUS_COLS).coalesce(1).write.insertInto(self.app_status_table)

    def append_sync_status(self, df: DataFrame) -> None:
        self.sync_status(df.sparkSession)
        df.select(*SYNC_STATUS_COLS).coalesce(1).write.insertInto(self.sync_status_table)


def _read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(ddl).orc(path)
    return spark.createDataFrame([], ddl)


@dataclass
class RawRunResult:
    batches: list[str]
    record_count: int
    version: int | None
    publish_action: str
    published: list[int]
    deleted_versions: list[str]
    quarantined: int = 0


def chosen_batches(spark: SparkSession, cfg: RawPipelineConfig, audit: AuditStore) -> list[str]:
    """The batches of a run. With a start the closed or open range,
    else every listed batch that the ledger (``app_status``) does not hold."""
    listing = list_batches(spark, landing_dir(cfg.sourcepath, cfg.tablename))
    if cfg.startbatchno is not None:
        taken = select_batches(listing, "batchno", cfg.startbatchno, cfg.endbatchno)
    else:
        taken = unprocessed_batches(listing, audit.app_status(spark), cfg.appname, cfg.tablename)
    return sorted(r["batchno"] for r in taken.collect())


def staged_delta(spark: SparkSession, cfg: RawPipelineConfig, schema: StructType, batches: list[str], run_ts: str) -> tuple[DataFrame, int]:
    """The prepared delta of the batches, run once and kept in the shared
    folder, and how many lines went to the quarantine (beside the landing
    folder's table, by batch)."""
    staged = stage_landing(spark, landing_dir(cfg.sourcepath, cfg.tablename), schema, batches, cfg.keys)
    if staged.n_quarantined:
        write_quarantine(staged.quarantined, quarantine_dir(cfg.targetpath, cfg.tablename))
    delta = prepare_delta(staged.good, cfg.keys, cfg.selectcols, cfg.rules, run_ts, date_partitioned=cfg.date_partitioned)
    return materialize(delta, "delta"), staged.n_quarantined


def rewritten_partitions(delta: DataFrame, base: DataFrame, cfg: RawPipelineConfig) -> DataFrame:
    """Every partition that the merge rewrites: the delta's, and those of the
    snapshot rows it selects, which differ only where fewer columns select
    (the date-partitioned layout selects by date)."""
    parts = partition_columns(cfg.rules)
    touch = parts[-1:] if cfg.date_partitioned else parts
    mine = touched_partitions(delta, parts)
    if touch == parts:
        return mine
    selected = restrict_to_touched(base, touched_partitions(delta, touch), touch)
    return mine.unionByName(touched_partitions(selected, parts)).distinct()


def landing_to_raw(
    spark: SparkSession,
    cfg: RawPipelineConfig,
    landing_schema: StructType | None,
    audit: AuditStore,
    run_ts: str,
    run_epoch: int,
    strict_publish: bool = False,
    manifest: bool = False,
    partition_table: str | None = None,
) -> RawRunResult:
    """Landing JSON -> quarantine -> SCD1 version -> publish -> retention.

    The chosen batches are parsed once; lines that cannot take part go to the
    quarantine. The delta is prepared once, merged in one plan and written
    once; the audit count is that of the committed files. With ``manifest``
    the snapshot is kept behind a manifest (``sinks.manifest``), else in
    ``t=0``. ``partition_table``: a catalog table over ``t=0`` whose new
    partitions are registered at the end (K11).
    """
    parts = partition_columns(cfg.rules)
    lroot = landing_dir(cfg.sourcepath, cfg.tablename)
    rroot = raw_dir(cfg.targetpath, cfg.tablename)
    snap_path = f"{rroot}/t=0"
    chosen = chosen_batches(spark, cfg, audit)
    if landing_schema is None and chosen:
        # A sample file, else what all chosen batches agree on
        landing_schema = sample_schema(spark, cfg.schemafile) if cfg.schemafile else merged_schema(spark, lroot, chosen)
    record_count, version, quarantined = 0, None, 0
    if chosen:
        size_shuffle_partitions(spark, input_bytes(spark, [f"{lroot}/batchno={b}" for b in chosen] + [snap_path]))
        delta, quarantined = staged_delta(spark, cfg, landing_schema, chosen, run_ts)
        schema = delta.schema
        if manifest:
            base = mf.read_published(spark, rroot, schema, parts)
        else:
            base = read_snapshot(spark, snap_path, schema) if path_exists(spark, snap_path) else spark.createDataFrame([], schema)
        # the date-partitioned layout selects snapshot rows by date (part_3)
        touch = parts[-1:] if cfg.date_partitioned else parts
        merged = scd1_merge(delta, base, cfg.keys, parts, touch_cols=touch)
        version = run_epoch
        vpath = f"{rroot}/t={version}"
        write_partitioned(merged, vpath, parts, mode="overwrite")
        # the touched list is partition metadata: written by Spark next to the
        # version, never gathered on the driver
        touched = rewritten_partitions(delta, base, cfg)
        touched.select(*[F.col(p).cast("string").alias(p) for p in parts]).write.mode("overwrite").json(f"{vpath}/_touched")
        record_count = count_rows(read_version(spark, vpath, partition_types(cfg.rules, cfg.date_partitioned)))
        batches_df = spark.createDataFrame([(b,) for b in chosen], "batchno string")
        audit.append_app_status(
            app_status_rows(batches_df, cfg.appname, cfg.tablename, run_ts, run_ts, record_count)
        )

    if manifest:
        action, published = publish_by_manifest(spark, cfg, audit, run_ts, strict_publish)
        deleted = cleanup_by_manifest(spark, cfg, audit, run_ts)
    else:
        action, published = publish(spark, cfg, audit, run_ts, strict_publish)
        deleted = cleanup(spark, cfg, audit, run_ts)
    if partition_table is not None:
        register_new_partitions(spark, partition_table, parts, snap_path)
    return RawRunResult(chosen, record_count, version, action, published, deleted, quarantined)


def landing_to_table(
    spark: SparkSession,
    cfg: RawPipelineConfig,
    landing_schema: StructType,
    audit: AuditStore,
    run_ts: str,
    run_epoch: int,
    table: str,
    table_path: str,
    buckets: int | None = None,
    versions: bool = False,
    strict_publish: bool = False,
) -> RawRunResult:
    """Landing JSON -> SCD1 merge -> published into a catalog snapshot
    bucketed by the merge keys (the at-scale layout, ``sinks.tables``).

    The snapshot is never shuffled: the touched partitions are read bucket
    by bucket, W2 runs with no exchange, and its output, already
    hash-partitioned like the buckets, is inserted as is (one file per
    bucket and partition value), in the same job that reads the touched
    partitions (a dynamic overwrite commits after all reads); the run is
    logged as a ``file_sync`` of ``run_epoch``. The first run creates the table with
    ``buckets`` (default: the shuffle partitions) buckets.

    With ``versions`` the merge is written beside the table and published by
    partition locations (``publish_table_versions``), with pending versions,
    retention and a way back as in the path layout.
    """
    from ..operators.scd import align_to
    from ..sinks.tables import bucket_count, create_bucketed_snapshot, publish_to_table, write_table_version

    parts = partition_columns(cfg.rules)
    lroot = landing_dir(cfg.sourcepath, cfg.tablename)
    chosen = chosen_batches(spark, cfg, audit)
    if not chosen:
        if versions and spark.catalog.tableExists(table):
            action, published = publish_table_versions(spark, cfg, audit, run_ts, table, table_path, strict_publish)
            return RawRunResult(chosen, 0, None, action, published, cleanup_table(spark, cfg, audit, run_ts, table, table_path))
        return RawRunResult(chosen, 0, None, "none", [], [])
    size_shuffle_partitions(spark, input_bytes(spark, [f"{lroot}/batchno={b}" for b in chosen] + [table_path]))
    delta, quarantined = staged_delta(spark, cfg, landing_schema, chosen, run_ts)
    if not spark.catalog.tableExists(table):
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        first = delta.repartition(n, *[F.col(k) for k in cfg.keys])
        create_bucketed_snapshot(first, table, cfg.keys, parts, n, table_path)
        touched = touched_partitions(delta, parts)
    else:
        n = bucket_count(spark, table)
        if n is None:
            raise ValueError(f"{table} is not bucketed")
        base = spark.table(table)
        touch = parts[-1:] if cfg.date_partitioned else parts
        merged = scd1_merge(delta, base, cfg.keys, parts, touch_cols=touch, buckets=n)
        touched = cut_lineage(rewritten_partitions(delta, align_to(base, delta), cfg))  # fixed before the table changes
        if versions:
            vpath = f"{versions_dir(table_path)}/t={run_epoch}"
            write_table_version(merged.select(*spark.table(table).columns), table, cfg.keys, parts, vpath)
            touched.select(*[F.col(p).cast("string").alias(p) for p in parts]).write.mode("overwrite").json(f"{vpath}/_touched")
            n_rows = count_rows(read_version(spark, vpath, partition_types(cfg.rules, cfg.date_partitioned)))
            batches_df = spark.createDataFrame([(b,) for b in chosen], "batchno string")
            audit.append_app_status(app_status_rows(batches_df, cfg.appname, cfg.tablename, run_ts, run_ts, n_rows))
            action, published = publish_table_versions(spark, cfg, audit, run_ts, table, table_path, strict_publish)
            deleted = cleanup_table(spark, cfg, audit, run_ts, table, table_path)
            return RawRunResult(chosen, n_rows, run_epoch, action, published, deleted, quarantined)
        publish_to_table(merged, table, parts, touched)
    record_count = count_rows(restrict_to_touched(spark.table(table).select(*parts), touched, parts))
    batches_df = spark.createDataFrame([(b,) for b in chosen], "batchno string")
    audit.append_app_status(app_status_rows(batches_df, cfg.appname, cfg.tablename, run_ts, run_ts, record_count))
    version = spark.createDataFrame([(run_epoch,)], "t bigint")
    audit.append_sync_status(sync_rows(version, cfg.appname, cfg.tablename, FILE_SYNC, run_ts, record_count))
    return RawRunResult(chosen, record_count, run_epoch, "publish", [run_epoch], [], quarantined)


def versions_dir(table_path: str) -> str:
    return f"{table_path.rstrip('/')}_versions"


def publish_table_versions(
    spark: SparkSession, cfg: RawPipelineConfig, audit: AuditStore, run_ts: str, table: str, table_path: str, strict: bool = False
) -> tuple[str, list[int]]:
    """P2 for a bucketed table: the pending version's partitions become the
    table's; several pending versions (D5) are unioned with W2 into one first.
    A stopped publish is done again by the next run."""
    from ..sinks.tables import bucket_count, publish_table_version, write_table_version

    parts, root = partition_columns(cfg.rules), versions_dir(table_path)
    action, pending = _pending(spark, cfg, audit, strict, root)
    if not pending:
        return action, []
    version, touched, n = _pending_rows(spark, cfg, pending, root)
    path = f"{root}/t={pending[-1]}"
    if len(pending) > 1:
        path += "_merged"
        laid_out = version.select(*spark.table(table).columns).repartition(bucket_count(spark, table), *[F.col(k) for k in cfg.keys])
        write_table_version(laid_out, table, cfg.keys, parts, path)
    publish_table_version(spark, table, parts, path, touched, f"{root}/_before/t={pending[-1]}")
    _log_sync(spark, cfg, audit, pending, run_ts, n)
    return action, pending


def cleanup_table(spark: SparkSession, cfg: RawPipelineConfig, audit: AuditStore, run_ts: str, table: str, table_path: str) -> list[str]:
    """P3 for a bucketed table: published versions in which none of its
    partitions lies any more are deleted and logged."""
    from ..sinks.tables import retire_table_versions

    parts, root = partition_columns(cfg.rules), versions_dir(table_path)
    cands = [r["batch_no"] for r in retention_candidates(audit.sync_status(spark), cfg.appname, cfg.tablename).collect()]
    folders = {b: f"{root}/t={b}" for b in cands}
    folders |= {f: f"{root}/{f}" for f in list_children(spark, root) if f.endswith("_merged")}
    gone = [b for b in retire_table_versions(spark, table, parts, folders) if b in cands]
    _log_deleted(spark, cfg, audit, gone, run_ts)
    return gone


def publish(
    spark: SparkSession, cfg: RawPipelineConfig, audit: AuditStore, run_ts: str, strict: bool = False
) -> tuple[str, list[int]]:
    """Publish pending versions into ``t=0``. One pending version is
    copied in; several (D5) are unioned with W2 first, unless ``strict``."""
    parts = partition_columns(cfg.rules)
    rroot = raw_dir(cfg.targetpath, cfg.tablename)
    action, pending = _pending(spark, cfg, audit, strict, rroot)
    if not pending:
        return action, []
    version, touched, n = _pending_rows(spark, cfg, pending, rroot)
    # one version: its files are already one-partition-each, copy without a shuffle
    publish_partitions(version, f"{rroot}/t=0", parts, touched, keep_layout=len(pending) == 1)
    _log_sync(spark, cfg, audit, pending, run_ts, n)
    return action, pending


def _pending(spark: SparkSession, cfg: RawPipelineConfig, audit: AuditStore, strict: bool, root: str) -> tuple[str, list[int]]:
    """The action (L5/D5) and the versions below ``root`` that it takes."""
    mark = sync_mark(audit.sync_status(spark), cfg.appname, cfg.tablename)
    pending = sorted(r["t"] for r in list_versions(spark, root).filter(F.col("t") > mark).collect())
    action = publish_decision(len(pending), strict)
    return action, pending if action in ("publish", "merge_all") else []


def _pending_rows(spark: SparkSession, cfg: RawPipelineConfig, pending: list[int], root: str) -> tuple[DataFrame, DataFrame | None, int]:
    """The rows that the pending versions publish (several: the union with W2,
    run once), the partitions they touch, and the number of rows."""
    parts = partition_columns(cfg.rules)
    ptypes = partition_types(cfg.rules, cfg.date_partitioned)
    paths = [f"{root}/t={v}" for v in pending]
    frames = [read_version(spark, p, ptypes).withColumn("_v", F.lit(v)) for p, v in zip(paths, pending)]
    # the touched lists of all pending versions, one read, kept distributed
    ddl = ", ".join(f"`{p}` string" for p in parts)
    tpaths = [f"{p}/_touched" for p in paths if path_exists(spark, f"{p}/_touched")]
    touched = spark.read.schema(ddl).json(tpaths) if tpaths else None
    version = frames[0]
    for f in frames[1:]:
        version = version.unionByName(f, allowMissingColumns=True)
    if len(frames) > 1:
        order = [*position_order(POS_COL), F.col(TS_COL).desc_nulls_last(), F.col("_v").desc()]
        version = materialize(latest_per_key(version, cfg.keys, order), "pending")
    return version.drop("_v"), touched, count_rows(version)


def _log_sync(spark: SparkSession, cfg: RawPipelineConfig, audit: AuditStore, versions: list[int], run_ts: str, n: int) -> None:
    rows = spark.createDataFrame([(v,) for v in versions], "t bigint")
    audit.append_sync_status(sync_rows(rows, cfg.appname, cfg.tablename, FILE_SYNC, run_ts, n))


def publish_by_manifest(
    spark: SparkSession, cfg: RawPipelineConfig, audit: AuditStore, run_ts: str, strict: bool = False
) -> tuple[str, list[int]]:
    """P2 by one pointer switch (``sinks.manifest``): the pending version's
    partitions are named in the next manifest where they lie; several pending
    versions (D5) are unioned with W2 into one ``t=<epoch>_merged`` folder first.

    A run may stop after any step: before the switch nothing is published and
    the next run does it again; after it, the next run finds the versions in
    the pointer and only logs them.
    """
    parts = partition_columns(cfg.rules)
    rroot = raw_dir(cfg.targetpath, cfg.tablename)
    action, pending = _pending(spark, cfg, audit, strict, rroot)
    if not pending:
        return action, []
    now = mf.read_pointer(spark, rroot)
    if now is None or now.upto < pending[-1]:
        version, touched, n = _pending_rows(spark, cfg, pending, rroot)
        folder = f"t={pending[-1]}"
        if len(pending) > 1:
            folder = f"t={pending[-1]}_merged"  # no version number, so never pending itself
            write_partitioned(version, f"{rroot}/{folder}", parts, mode="overwrite")
            version = read_version(spark, f"{rroot}/{folder}", partition_types(cfg.rules, cfg.date_partitioned))
        new = mf.Pointer(now.number + 1 if now else 1, pending[-1], n)
        mf.write_manifest(mf.next_manifest(spark, rroot, parts, version, folder, touched), rroot, new.number)
        mf.switch_pointer(spark, rroot, new)
        now = new
    _log_sync(spark, cfg, audit, pending, run_ts, now.rows)
    return action, pending


def cleanup_by_manifest(spark: SparkSession, cfg: RawPipelineConfig, audit: AuditStore, run_ts: str, keep: int = 1) -> list[str]:
    """P3 behind a manifest: published versions that none of the last ``keep``
    manifests names are deleted and logged; of versions still named, replaced
    partitions are deleted."""
    parts = partition_columns(cfg.rules)
    rroot = raw_dir(cfg.targetpath, cfg.tablename)
    cands = [r["batch_no"] for r in retention_candidates(audit.sync_status(spark), cfg.appname, cfg.tablename).collect()]
    merges = [f for f in list_children(spark, rroot) if f.endswith("_merged")]
    gone = mf.retire(spark, rroot, parts, [f"t={b}" for b in cands] + merges, keep)
    deleted = sorted(b for b in cands if f"t={b}" in gone)
    _log_deleted(spark, cfg, audit, deleted, run_ts)
    return deleted


def _log_deleted(spark: SparkSession, cfg: RawPipelineConfig, audit: AuditStore, versions: list[str], run_ts: str) -> None:
    if versions:
        rows = spark.createDataFrame([(b,) for b in versions], "batch_no string")
        audit.append_sync_status(sync_rows(rows, cfg.appname, cfg.tablename, BATCH_DELETED, run_ts, None, batch_col="batch_no"))


def read_version(spark: SparkSession, path: str, part_types: dict[str, str]) -> DataFrame:
    """A version folder with its partition columns declared (H3): the
    file schema comes from the ORC footers, partition types from the rules."""
    inferred = spark.read.orc(path).schema
    ddl = ", ".join(
        f"`{f.name}` {part_types.get(f.name, f.dataType.simpleString())}" for f in inferred.fields
    )
    return spark.read.schema(ddl).orc(path)


def cleanup(spark: SparkSession, cfg: RawPipelineConfig, audit: AuditStore, run_ts: str) -> list[str]:
    """Delete published versions not yet deleted (never ``t=0``) and
    log a ``batch_deleted`` row for each folder actually removed."""
    rroot = raw_dir(cfg.targetpath, cfg.tablename)
    cands = [r["batch_no"] for r in retention_candidates(audit.sync_status(spark), cfg.appname, cfg.tablename).collect()]
    gone = [b for b in cands if delete_path(spark, f"{rroot}/t={b}")]
    _log_deleted(spark, cfg, audit, gone, run_ts)
    return gone


# ---------------------------------------------------------------- external


class PushFailed(RuntimeError):
    pass


def incremental_extract(
    spark: SparkSession,
    cfg: ExternalConfig,
    audit: AuditStore,
    query_text: str,
    jdbc: dict,
) -> DataFrame:
    """P6 + S8: lower bound from the config's from-date or the last
    successful run, put into the source query, read over JDBC (``jdbc``
    holds url/user/password/driver and optional partitioned-read bounds)."""
    from ..operators.batches import extract_mark
    from ..sources.jdbc import read_jdbc_query

    mark = extract_mark(cfg.fromdate, audit.app_status(spark), cfg.app_name, cfg.table_name)
    return read_jdbc_query(spark, query_text, mark, **jdbc)


def trusted_to_external(
    source: DataFrame,
    cfg: ExternalConfig,
    client: Callable[[dict], tuple[int, str]],
    audit: AuditStore,
    env: str,
    run_ts: str,
    run_batch: str,
    record_date: str,
    error_schema: StructType | str = "error string, message string",
    size: int = ext.BATCH_SIZE,
    key_param: str | None = None,
    num_partitions: int | None = None,
    concurrency: int = 1,
) -> dict:
    """Extract -> allow/block split -> requests of ``size`` ids -> push ->
    ledger -> status / error tables -> audit row.

    The source is read once, into the shared folder; the total, the ranges and
    the ids all come from that copy. Every answer goes into the request ledger
    (``<statuspath>_requests``) before anything else, and status and errors of
    the run's batch are written from the ledger, replacing what an earlier try
    wrote, so a repeated run holds each request once. Every outcome is stored
    before a failure is raised (D18). A run with failures leaves no audit row,
    so its ids are extracted again; those that it got accepted are left out
    then, under the same ``run_batch`` or a new one. The audit count is that of
    all extracted rows.

    Requests are spread over ``num_partitions`` tasks (default: the session's
    parallelism), ``concurrency`` calls at a time in each."""
    spark = source.sparkSession
    source = materialize(source, "extract")
    n_total = count_rows(source)
    ledger_path = f"{cfg.statuspath.rstrip('/')}_requests"
    ledger = materialize(_request_ledger(spark, ledger_path), "request_ledger")
    mark = mark_value(audit.app_status(spark), cfg.app_name, cfg.table_name)
    split = ext.without_accepted(ext.flag_split(source), ledger, mark)
    # a repeated run_batch numbers on, so that no request key names two requests
    sent = ledger.filter(F.col("batch_no") == run_batch).agg(F.max("request_seq")).first()[0] or 0
    payload = ext.number_requests(ext.request_batches(split, size=size), size=size)
    payload = cut_lineage(payload.withColumn("request_seq", F.col("request_seq") + F.lit(sent)))
    num_partitions = num_partitions or spark.sparkContext.defaultParallelism
    # reliable checkpoint, not persist: a lost executor must not make the
    # plan call the API again when the responses are read a second time
    responses = cut_lineage(
        ext.push_requests(
            payload, client, (cfg.param1, cfg.param2), key_param=key_param, run_batch=run_batch,
            num_partitions=num_partitions, concurrency=concurrency,
        )
    )
    kept = [f.name for f in ledger.schema.fields if f.name != "batch_no"]
    told = responses.select(*kept, F.lit(run_batch).alias("batch_no"), F.lit(sent).cast("string").alias("after"))
    _replace_partitions(told, ledger_path, ["batch_no", "after"])
    mine = _request_ledger(spark, ledger_path).filter(F.col("batch_no") == run_batch)
    _replace_partitions(ext.route_status(mine, cfg.app_name, env, record_date, run_batch), cfg.statuspath, ["status_record_date_dt", "batch_no"])
    errors = ext.route_errors(mine, record_date, run_batch, error_schema)
    if not mine.filter(F.col("code").isNull() | (F.col("code") != 200)).isEmpty():
        _replace_partitions(errors, cfg.errorpath, ["part_record_date_dt", "batch_no"])
    n_err = responses.filter(F.col("code").isNull() | (F.col("code") != 200)).count()
    if n_err:
        raise PushFailed(f"{n_err} API requests failed; see {cfg.errorpath}")
    if n_total > 0:
        one = spark.createDataFrame([(run_batch,)], "batchno string")
        audit.append_app_status(app_status_rows(one, cfg.app_name, cfg.table_name, run_ts, run_ts, n_total))
    return {"records": n_total, "errors": n_err}


def _request_ledger(spark: SparkSession, path: str) -> DataFrame:
    columns = spark.createDataFrame([], ext.LEDGER_DDL).columns
    return _read_or_empty(spark, path, ext.LEDGER_DDL).select(*columns)


def _replace_partitions(df: DataFrame, path: str, part_cols: list[str]) -> None:
    """K1/K5 that can be repeated: the partitions that ``df`` holds are replaced."""
    (
        df.hint("rebalance", *part_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*part_cols)
        .orc(path)
    )


# ---------------------------------------------------------------- GST flat files


def generate_flat(lines: DataFrame, out_root: str, section: str, run_date: str, summary_path: str) -> dict:
    """Transform, fail when nothing is left, one CSV per type,
    one summary row appended."""
    flat = flt.flat_transform(lines, run_date)
    if flat.isEmpty():
        raise ValueError(f"nothing to export for {section} on {run_date}")
    out = f"{out_root.rstrip('/')}/flatfiles/{section}/{run_date}"
    from ..sinks.files import export_by_type, name_type_folders

    export_by_type(flat, out)
    files = name_type_folders(flat.sparkSession, out, "gst_type", lambda t: flt.export_file_name(section, t, run_date))
    summary = flt.flat_summary(flat, section, run_date)
    append_csv(summary, summary_path, header=True)
    row = summary.first()
    return {"records": row["record_count"], "files": row["file_count"], "path": out, "outputs": files}


def fetch_gst(
    sessions: DataFrame,
    schedules: DataFrame,
    status: DataFrame,
    fetch: Callable[[dict, int], tuple[int, str]],
    base_url: str,
    data_schema: StructType | str,
    out_path: str,
    run_ts: str,
    backoff: bool = True,
    summary_path: str | None = None,
    num_partitions: int | None = None,
    concurrency: int = 1,
) -> dict:
    """S14 + P12-P17: fan-out, fetch with retry on executors, parse the
    envelopes, keep VALID/ACTIVE rows against the status file, write JSON
    partitioned by (gst_type, fy). Failed calls, envelopes and payloads come
    back as an action table. A status table with gst_type and fy is matched on
    them as well (M1). Requests are spread over ``num_partitions`` tasks
    (default: the session's parallelism), ``concurrency`` calls at a time."""
    reqs = rsp.request_fanout(sessions, schedules, base_url)
    tasks = num_partitions or sessions.sparkSession.sparkContext.defaultParallelism
    fetched = cut_lineage(rsp.fetch_table(reqs, fetch, backoff=backoff, num_partitions=tasks, concurrency=concurrency))  # calls happen once
    named = fetched.withColumn("request_id", F.col("url"))
    parsed = rsp.parse_envelope(named.filter(F.col("outcome") == "ok"))
    data = rsp.parse_data(parsed, data_schema, ["gst_type", "fy"])
    key = ["gstin", *(c for c in ("gst_type", "fy") if c in status.columns)]
    valid = rsp.valid_records(data, status, key)
    write_json_by(valid, out_path, ["gst_type", "fy"])
    if summary_path is not None:
        append_csv(rsp.fetch_summary(valid, run_ts, fetched), summary_path)
    metrics = rsp.api_metrics(fetched).first().asDict()
    unread = parsed.filter(~F.col("ok")).unionByName(rsp.data_failures(parsed, data_schema))
    failures = rsp.failed_actions(named, run_ts).unionByName(rsp.failed_actions(unread, run_ts))
    return {"metrics": metrics, "failures": failures, "fetched": fetched}
