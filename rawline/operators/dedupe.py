"""Top-1 per key.

``row_number() ... = 1`` lets Catalyst plan a *partial* WindowGroupLimit
before the shuffle, so each map task sends at most one row per key: a key
holding a third of the table costs one row per map task on the wire, not
a third of the table in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import position_order


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order``. A final tie-break on
    a hash of the whole row makes the pick repeatable across runs."""
    tie = F.xxhash64(*[F.col(c) for c in df.columns]).desc()
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order, tie)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_in_delta(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str = "kafka_ts",
    pos_col: str = "trail_file_pos",
    lexicographic: bool = False,
) -> DataFrame:
    """Latest row per key by ``kafka_ts`` desc, then position desc."""
    order = [F.col(ts_col).desc_nulls_last(), *position_order(pos_col, lexicographic)]
    return latest_per_key(df, keys, order)
