"""Batch selection and high-water marks.

A selection is a *predicate* on the string batch column. Applied to a
landing dataset partitioned by ``batchno`` it becomes a partition filter,
so only the chosen batch directories are listed and read.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.batch_ids import is_valid_batch_id


def valid_batch_text(value: str | None) -> bool:
    """Driver-side F17 for a config scalar: 14 digits that parse as
    ``yyyyMMddHHmmss`` and format back to the same text."""
    if value is None or len(value) != 14 or not value.isdigit():
        return False
    try:
        parsed = _dt.datetime.strptime(value, "%Y%m%d%H%M%S")
    except ValueError:
        return False
    return parsed.strftime("%Y%m%d%H%M%S") == value


def batch_predicate(
    batch_col: str = "batchno",
    start: str | None = None,
    end: str | None = None,
    mark: str | None = None,
) -> Column:
    """Which batches a run takes.

    - start set: closed range [start, end] when end is set, else >= start;
    - start unset: batches after the high-water ``mark`` (end is ignored).

    Names that are not valid batch ids are never taken (D19). A bad start
    or end, or no mark without a start, raises (D6) instead of failing later.
    """
    c = F.col(batch_col)
    if start is not None:
        if not valid_batch_text(str(start)):
            raise ValueError(f"invalid startbatchno {start!r}: expected yyyyMMddHHmmss")
        if end is not None:
            if not valid_batch_text(str(end)):
                raise ValueError(f"invalid endbatchno {end!r}: expected yyyyMMddHHmmss")
            rng = (c >= F.lit(str(start))) & (c <= F.lit(str(end)))
        else:
            rng = c >= F.lit(str(start))
    else:
        if mark is None:
            raise ValueError("no previous run recorded for this table: set startbatchno for the first run")
        rng = c > F.lit(str(mark))
    return rng & is_valid_batch_id(c)


def select_batches(
    listing: DataFrame,
    batch_col: str = "batchno",
    start: str | None = None,
    end: str | None = None,
    mark: str | None = None,
) -> DataFrame:
    """P4 over a listing table (one row per landing batch directory)."""
    return listing.filter(batch_predicate(batch_col, start, end, mark))


def high_water_mark(
    status: DataFrame,
    app_name: str,
    table_name: str,
    activity_type: str | None = None,
    batch_col: str = "batch_no",
    by: Sequence[str] = (),
) -> DataFrame:
    """A2: one-row frame ``mark`` = max batch id logged for the app/table
    (optionally one activity type); null when nothing was logged. With ``by``
    one mark per value of those columns."""
    cond = (F.col("app_name") == app_name) & (F.col("table_name") == table_name)
    if activity_type is not None:
        cond = cond & (F.col("activity_type") == activity_type)
    logged = status.filter(cond)
    return (logged.groupBy(*by) if by else logged).agg(F.max(batch_col).alias("mark"))


def mark_value(status: DataFrame, app_name: str, table_name: str, activity_type: str | None = None) -> str | None:
    """The mark as a driver scalar (one aggregated value, L1)."""
    return high_water_mark(status, app_name, table_name, activity_type).first()["mark"]


def processed_batches(status: DataFrame, app_name: str, table_name: str, batch_col: str = "batch_no") -> DataFrame:
    """The ledger: every batch id logged for the app/table, once."""
    logged = status.filter((F.col("app_name") == app_name) & (F.col("table_name") == table_name))
    return logged.select(F.col(batch_col).cast("string").alias("batchno")).distinct()


def unprocessed_batches(listing: DataFrame, status: DataFrame, app_name: str, table_name: str) -> DataFrame:
    """P4/F7 by ledger: the listed batches since the first logged one that no
    run has logged. After the last logged batch these are the ones that the
    mark selects; a batch folder that arrives below the mark is taken as well,
    and only once. Batches before the first logged one were left out by the
    start of the first run and stay out. With no batch logged it is an error,
    as for the mark (D6)."""
    ledger = processed_batches(status, app_name, table_name)
    first = ledger.agg(F.min("batchno").alias("first")).first()["first"]
    if first is None:
        raise ValueError("no previous run recorded for this table: set startbatchno for the first run")
    since = listing.filter((F.col("batchno") > F.lit(first)) & is_valid_batch_id(F.col("batchno")))
    return since.join(ledger, "batchno", "left_anti")


def extract_mark(from_datetime: str | None, status: DataFrame | None, app_name: str, table_name: str) -> str:
    """The lower bound of an incremental extract: an explicit, valid
    from-date wins, else the last successful batch of the app/table (D6,
    D10: one strict check for both)."""
    if from_datetime is not None:
        if not valid_batch_text(str(from_datetime)):
            raise ValueError(f"invalid fromdate {from_datetime!r}: expected yyyyMMddHHmmss")
        return str(from_datetime)
    mark = mark_value(status, app_name, table_name) if status is not None else None
    if mark is None:
        raise ValueError("no previous extract recorded: set fromdate for the initial load")
    return mark


def substitute_mark(query: str, mark: str, placeholder: str = "dummy_date") -> str:
    """Put a validated 14-digit mark into a source query text
    (plain replace, not a regex)."""
    if not valid_batch_text(mark):
        raise ValueError(f"refusing to substitute {mark!r}: not a yyyyMMddHHmmss value")
    return query.replace(placeholder, mark)


def incremental_filter(source: DataFrame, ts_col: str, mark: str) -> DataFrame:
    """P6 on a DataFrame source: rows after the mark (typed comparison, so
    the predicate is pushed into the scan)."""
    bound = F.to_timestamp_ntz(F.lit(mark), F.lit("yyyyMMddHHmmss")).cast(source.schema[ts_col].dataType)
    return source.filter(F.col(ts_col) > bound)
