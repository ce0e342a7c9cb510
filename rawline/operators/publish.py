"""Version publishing and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import mark_value

FILE_SYNC = "file_sync"
PARTITION_SYNC = "partition_sync"
BATCH_DELETED = "batch_deleted"


def sync_mark(sync_log: DataFrame, app_name: str, table_name: str) -> int:
    """Highest version already published (``file_sync``), 0 when none.
    Compared as a number against ``t`` (F8/H8), so the text is checked."""
    mark = mark_value(sync_log, app_name, table_name, FILE_SYNC)
    if mark is None:
        return 0
    if not str(mark).isdigit():
        raise ValueError(f"sync mark {mark!r} is not a version number")
    return int(mark)


def pending_versions(versions: DataFrame, mark: int, version_col: str = "t") -> DataFrame:
    """F8 + S5: versions written after the last published one."""
    return versions.select(version_col).distinct().filter(F.col(version_col) > F.lit(mark))


def publish_decision(n_pending: int, strict: bool = False) -> str:
    """Nothing to do, publish the one pending version, or (more
    than one) merge them all; ``strict`` keeps the one-version guard."""
    if n_pending == 0:
        return "none"
    if n_pending == 1:
        return "publish"
    return "skip" if strict else "merge_all"


def pending_with_decision(versions: DataFrame, mark: int, strict: bool = False, version_col: str = "t") -> DataFrame:
    """Pending versions annotated with how many there are and the action
    taken. The count is one aggregated scalar (the publish decision is a
    driver decision anyway); rows stay distributed."""
    pend = pending_versions(versions, mark, version_col)
    n = pend.count()
    return pend.withColumn("n_pending", F.lit(n).cast("bigint")).withColumn(
        "action", F.lit(publish_decision(n, strict))
    )


def retention_candidates(sync_log: DataFrame, app_name: str, table_name: str) -> DataFrame:
    """Versions published (file_sync) and not yet deleted, never the
    live snapshot ``0``. One partial+final aggregate per batch_no."""
    log = sync_log.filter((F.col("app_name") == app_name) & (F.col("table_name") == table_name))

    def n(kind: str):
        return F.sum(F.when(F.col("activity_type") == kind, 1).otherwise(0)).cast("bigint")

    agg = log.groupBy("batch_no").agg(
        n(FILE_SYNC).alias("file_sync"), n(PARTITION_SYNC).alias("part_sync"), n(BATCH_DELETED).alias("batch_del")
    )
    return agg.filter((F.col("file_sync") > 0) & (F.col("batch_del") == 0) & (F.col("batch_no") != "0"))
