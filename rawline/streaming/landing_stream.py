"""Landing folder as a stream: each micro-batch is merged (SCD1) and
published into the snapshot (survey extension E1; the reference is batch
only, this runs the same operators from ``foreachBatch``).

Exactly-once comes from the checkpoint, which a restart must name again, and
from a ledger of epochs: a micro-batch that the ledger holds was published
before the restart and is skipped. One that stopped between publishing and the
ledger is merged again, which changes nothing (the snapshot holds its rows, and
ties keep the snapshot row). The ledger's rows are the audit rows of the
micro-batches (``EpochLedger``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..config import RawPipelineConfig
from ..functions.columns import partition_columns
from ..operators.scd import align_to, prepare_delta, restrict_to_touched, scd1_merge, touched_partitions
from ..operators.audit import app_status_rows
from ..runtime import cut_lineage, materialize, scratch_path
from ..sinks.files import count_rows, list_children, path_exists, publish_partitions
from ..sinks.tables import bucket_count, create_bucketed_snapshot, publish_to_table
from ..sources.landing import landing_dir, raw_dir, read_snapshot


@dataclass
class EpochLedger:
    """The app_status rows of a stream's micro-batches, one per landing batch
    and epoch, below ``path`` by stream and epoch. ``stream`` names the query
    across restarts (one name per checkpoint). Writing an epoch again replaces
    its rows."""

    path: str
    stream: str

    def _folder(self, epoch: int) -> str:
        return f"{self.path.rstrip('/')}/stream={self.stream}/epoch={epoch}"

    def holds(self, spark: SparkSession, epoch: int) -> bool:
        # the folder appears with the job's commit marker last
        return "_SUCCESS" in list_children(spark, self._folder(epoch))

    def write(self, rows: DataFrame, epoch: int) -> None:
        rows.coalesce(1).write.mode("overwrite").orc(self._folder(epoch))

    def app_status(self, spark: SparkSession) -> DataFrame:
        """All audit rows so far, as the batch jobs' ``app_status``."""
        from ..plans.jobs import APP_STATUS_DDL

        folder = f"{self.path.rstrip('/')}/stream={self.stream}"
        done = [int(n.split("=")[1]) for n in list_children(spark, folder) if n.startswith("epoch=")]
        paths = [self._folder(e) for e in done if self.holds(spark, e)]
        return spark.read.schema(APP_STATUS_DDL).orc(paths) if paths else spark.createDataFrame([], APP_STATUS_DDL)


def merge_micro_batch(
    cfg: RawPipelineConfig,
    run_ts: str,
    table: str | None = None,
    table_path: str | None = None,
    buckets: int | None = None,
    ledger: EpochLedger | None = None,
):
    """The ``foreachBatch`` function: merge one micro-batch into ``t=0``,
    or, with ``table``, into a catalog snapshot bucketed by the keys
    (created at ``table_path`` by the first micro-batch; ``sinks.tables``)."""
    parts = partition_columns(cfg.rules)
    touch = parts[-1:] if cfg.date_partitioned else parts  # as in the batch job
    snap_path = f"{raw_dir(cfg.targetpath, cfg.tablename)}/t=0"

    def rewritten(delta: DataFrame, base: DataFrame) -> DataFrame:
        """Partitions that the merge replaces: the delta's and those of the
        snapshot rows that it selects."""
        selected = restrict_to_touched(base, touched_partitions(delta, touch), touch)
        return touched_partitions(delta, parts).unionByName(touched_partitions(selected, parts)).distinct()

    def into_table(spark: SparkSession, delta: DataFrame) -> None:
        if not spark.catalog.tableExists(table):
            n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            first = delta.repartition(n, *[F.col(k) for k in cfg.keys])
            create_bucketed_snapshot(first, table, cfg.keys, parts, n, table_path)
            return
        n = bucket_count(spark, table)
        base = spark.table(table)
        merged = scd1_merge(delta, base, cfg.keys, parts, touch_cols=touch, buckets=n)
        publish_to_table(merged, table, parts, cut_lineage(rewritten(delta, align_to(base, delta))))

    def into_path(spark: SparkSession, delta: DataFrame, epoch_id: int) -> None:
        if path_exists(spark, snap_path):
            base = read_snapshot(spark, snap_path, delta.schema)
        else:
            base = spark.createDataFrame([], delta.schema)
        merged = scd1_merge(delta, base, cfg.keys, parts, touch_cols=touch)
        touched = cut_lineage(rewritten(delta, base))  # before partitions are replaced
        # materialise before overwriting partitions the plan reads from
        staged = scratch_path(spark, f"stream-{epoch_id}")
        merged.write.mode("overwrite").orc(staged)
        publish_partitions(spark.read.schema(delta.schema).orc(staged), snap_path, parts, touched)

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if ledger is not None and ledger.holds(spark, epoch_id):
            return
        batch = materialize(batch, f"epoch-{epoch_id}") if ledger is not None else batch
        prepared = prepare_delta(batch, cfg.keys, cfg.selectcols, cfg.rules, run_ts, date_partitioned=cfg.date_partitioned)
        delta = materialize(prepared, f"delta-{epoch_id}")
        if not delta.isEmpty():
            if table is not None:
                into_table(spark, delta)
            else:
                into_path(spark, delta, epoch_id)
        if ledger is not None:  # an epoch without rows is logged as done, too
            batches = batch.select("batchno").distinct()
            rows = app_status_rows(batches, cfg.appname, cfg.tablename, run_ts, run_ts, count_rows(delta))
            ledger.write(rows, epoch_id)

    return run


def start_landing_stream(
    spark: SparkSession,
    cfg: RawPipelineConfig,
    landing_schema: StructType,
    run_ts: str,
    checkpoint: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    table: str | None = None,
    table_path: str | None = None,
    buckets: int | None = None,
    ledger: EpochLedger | None = None,
) -> StreamingQuery:
    """Stream the landing JSON folder through ``merge_micro_batch`` (into
    ``t=0``, or into the bucketed catalog snapshot ``table``)."""
    if table is not None and table_path is None:
        raise ValueError("table needs table_path")
    full = StructType(
        [f for f in landing_schema.fields if f.name != "batchno"] + [StructField("batchno", StringType())]
    )
    reader = spark.readStream.schema(full)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(landing_dir(cfg.sourcepath, cfg.tablename))
    fn = merge_micro_batch(cfg, run_ts, table, table_path, buckets, ledger)
    writer = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
