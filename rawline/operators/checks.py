"""Input checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's (required session columns).
REQUIRED_SESSION_COLUMNS = ("GSTIN1", "COMPANY1", "USER1")


def non_empty(df: DataFrame | None) -> bool:
    """the frame exists and has a row (reads at most one row)."""
    return df is not None and not df.isEmpty()


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_SESSION_COLUMNS) -> list[str]:
    """required columns the frame lacks, in the order asked."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def column_check(df: DataFrame, required: Sequence[str] = REQUIRED_SESSION_COLUMNS) -> DataFrame:
    """F19/F20 as rows: each required column, whether the frame has it, and
    whether the frame has a row at all (at most one row is read)."""
    have = set(df.columns)
    asked = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c in have).alias("present")) for c in required])
    one = df.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows"))
    return one.select(F.explode(asked).alias("c"), "has_rows").select("c.*", "has_rows")


def validate_sessions(df: DataFrame | None, required: Sequence[str] = REQUIRED_SESSION_COLUMNS) -> None:
    """Raise with the reason when a session frame is empty or incomplete."""
    if not non_empty(df):
        raise ValueError("session list is empty")
    miss = missing_columns(df, required)
    if miss:
        raise ValueError("missing required columns: " + ", ".join(miss))
