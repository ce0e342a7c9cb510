"""Audit rows (P5, P11, J5): app_status, sync_status and run summaries.

Rows are built as projections over a frame that already has one row per
item (batches, versions, candidates), never by a driver loop of one-row
frames. Times are run arguments, stored as wall-clock ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .publish import BATCH_DELETED, FILE_SYNC

APP_STATUS_COLS = ["app_name", "table_name", "batch_no", "process_start_time", "process_end_time", "record_count"]
SYNC_STATUS_COLS = [
    "app_name",
    "table_name",
    "batch_no",
    "activity_type",
    "file_sync_time",
    "partition_sync_time",
    "file_delete_time",
    "record_count",
]


def _ts(value: str | None) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _count(value: int | Column | None) -> Column:
    if isinstance(value, Column):
        return value.cast("bigint")
    return F.lit(value).cast("bigint")


def app_status_rows(
    batches: DataFrame,
    app_name: str,
    table_name: str,
    start_ts: str,
    end_ts: str,
    record_count: int | Column,
    batch_col: str = "batchno",
) -> DataFrame:
    """One row per processed batch, each with the run's total count."""
    return batches.select(
        F.lit(app_name).alias("app_name"),
        F.lit(table_name).alias("table_name"),
        F.col(batch_col).cast("string").alias("batch_no"),
        _ts(start_ts).alias("process_start_time"),
        _ts(end_ts).alias("process_end_time"),
        _count(record_count).alias("record_count"),
    )


def sync_rows(
    items: DataFrame,
    app_name: str,
    table_name: str,
    activity: str,
    at_ts: str,
    record_count: int | Column | None,
    batch_col: str = "t",
) -> DataFrame:
    """sync_status rows: ``file_sync`` for published versions, or
    ``batch_deleted`` for removed ones (null count, D12)."""
    sync_t = at_ts if activity == FILE_SYNC else None
    del_t = at_ts if activity == BATCH_DELETED else None
    return items.select(
        F.lit(app_name).alias("app_name"),
        F.lit(table_name).alias("table_name"),
        F.col(batch_col).cast("string").alias("batch_no"),
        F.lit(activity).alias("activity_type"),
        _ts(sync_t).alias("file_sync_time"),
        _ts(None).alias("partition_sync_time"),
        _ts(del_t).alias("file_delete_time"),
        _count(record_count if activity != BATCH_DELETED else None).alias("record_count"),
    )


def flat_run_summary(section: str, process_date: str, record_count: Column, file_count: Column, error_count: int = 0) -> list[Column]:
    """P11 (flat files): the summary row's columns, as aggregate expressions."""
    return [
        F.lit(section).alias("section"),
        F.lit(process_date).alias("process_date"),
        record_count.cast("bigint").alias("record_count"),
        file_count.cast("bigint").alias("file_count"),
        F.lit(error_count).cast("bigint").alias("error_count"),
        F.lit("COMPLETED").alias("status"),
    ]
