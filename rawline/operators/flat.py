"""Flat-file transform and export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .audit import flat_run_summary

# Fixed values that must equal the reference's.
DATE_FORMAT = "yyyy-MM-dd"
KEEP_STATUSES = ("VALID", "ACTIVE")


def flat_transform(df: DataFrame, run_date: str) -> DataFrame:
    """Keep VALID/ACTIVE (exact case), whole-row distinct, then add
    load_timestamp, process_date, month, year, gstin_hash.

    The added columns are deterministic functions of the row (and one
    constant), so taking the distinct first gives the same rows while the
    shuffle carries only the input columns; the hash aggregate's map-side
    partial collapses repeated rows before the shuffle. A bad date gives
    null, not an error.
    """
    kept = df.filter(F.col("status").isin(*KEEP_STATUSES)).distinct()
    process_date = F.try_to_date(F.col("transaction_date"), DATE_FORMAT)
    out = kept.withColumns({"load_timestamp": F.lit(run_date), "process_date": process_date})
    return out.withColumns(
        {
            "month": F.month("process_date"),
            "year": F.year("process_date"),
            "gstin_hash": F.md5(F.col("gstin").cast("string")),
        }
    )


def type_counts(flat: DataFrame, type_col: str = "gst_type") -> DataFrame:
    """Rows per type: what each exported file holds."""
    return flat.groupBy(type_col).agg(F.count(F.lit(1)).cast("bigint").alias("record_count"))


def flat_summary(flat: DataFrame, section: str, process_date: str, type_col: str = "gst_type") -> DataFrame:
    """One summary row (section, process_date, record_count,
    file_count, error_count, status), from the per-type counts: one file
    per type, the null type included (D17)."""
    per_type = type_counts(flat, type_col)
    return per_type.agg(
        *flat_run_summary(
            section, process_date, F.coalesce(F.sum("record_count"), F.lit(0)), F.count(F.lit(1))
        )
    )


def export_file_name(section: str, gst_type: str | None, day: str) -> str:
    """P10: ``<section>_<type>_<date>.csv`` (a null type is named "null")."""
    return f"{section}_{'null' if gst_type is None else gst_type}_{day}.csv"
