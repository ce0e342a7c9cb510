"""Batch-id and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's (time text formats).
BATCH_FORMAT = "yyyyMMddHHmmss"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_valid_batch_id(c: str | Column) -> Column:
    """the text is a wall-clock time ``yyyyMMddHHmmss`` (so
    2024-02-30, 13 digits or letters are rejected). Never null, and the same
    in every session time zone: an hour that a zone skips is a valid name."""
    c = _col(c)
    year, month, day = F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2)
    date = F.concat_ws("-", year, month, day).try_cast("date")
    ok = c.rlike(r"^[0-9]{14}$") & (year > F.lit("0000")) & date.isNotNull()
    ok = ok & (F.substring(c, 9, 2) < "24") & (F.substring(c, 11, 2) < "60") & (F.substring(c, 13, 2) < "60")
    return F.coalesce(ok, F.lit(False))


def batch_id_of(ts: str | Column, unit: str = "day") -> Column:
    """Landing batch id of a timestamp, truncated to ``unit``."""
    return F.date_format(F.date_trunc(unit, _col(ts)), BATCH_FORMAT)


def epoch_seconds(ts: str | Column) -> Column:
    """Seconds since 1970-01-01 of a wall-clock timestamp, independent of
    the session time zone (days * 86400 + seconds of day)."""
    ts = _col(ts)
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
