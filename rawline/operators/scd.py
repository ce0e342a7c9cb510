"""SCD type-1 merge of a landing delta into a partitioned snapshot.

Shape of the plan::

    landing --select/rename--> W1 latest per key --> cast all to string
            --> derived columns (keys, partitions)            = prepared delta
    snapshot --partition filter (touched only)--> align columns
    prepared delta UNION touched snapshot --> W2 latest per key = new content
                                                of the touched partitions

Only partitions the delta touches are read from the snapshot: with a
file-based snapshot the touched values become a ``PartitionFilters`` entry
on the scan (no data read for other partitions). The list of touched values
is partition metadata, as the driver holds it for every directory it lists:
at most one value per partition directory, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from ..functions.columns import ColumnRule, cast_all, derive_columns, position_order
from .dedupe import latest_in_delta, latest_per_key

TS_COL = "kafka_ts"
POS_COL = "trail_file_pos"
UPDATED_COL = "last_updated_date"
SRC_TS_COL = "current_ts"
SRC_POS_COL = "pos"


def prepare_landing(landing: DataFrame, select_cols: Sequence[str], run_ts: str) -> DataFrame:
    """J1 + J4 + J5: keep the configured columns, copy ``current_ts`` to
    ``kafka_ts`` and ``pos`` to ``trail_file_pos``, stamp the run time."""
    df = landing.select(*select_cols)
    df = df.withColumns(
        {TS_COL: F.col(SRC_TS_COL), POS_COL: F.col(SRC_POS_COL), UPDATED_COL: F.lit(run_ts)}
    )
    return df.drop(SRC_TS_COL, SRC_POS_COL)


def prepare_delta(
    landing: DataFrame,
    keys: Sequence[str],
    select_cols: Sequence[str],
    rules: Sequence[ColumnRule],
    run_ts: str,
    date_partitioned: bool = False,
    lexicographic: bool = False,
) -> DataFrame:
    """Steps (1)-(4) of the merge: select/rename, W1, cast-all, rules."""
    df = prepare_landing(landing, select_cols, run_ts)
    # keys become text before W1, so that W1 and W2 (and the buckets) share one hash layout
    df = df.withColumns({k: F.col(k).cast("string") for k in keys})
    df = latest_in_delta(df, keys, TS_COL, POS_COL, lexicographic)
    df = cast_all(df, "string")
    return derive_columns(df, rules, date_partitioned)


def touched_partitions(delta: DataFrame, part_cols: Sequence[str]) -> DataFrame:
    """A4/A5: distinct partition values of the prepared delta, as a
    partitioned write stores them (an empty text is the null partition)."""
    text = {f.name for f in delta.schema.fields if f.dataType.simpleString() == "string"}
    return delta.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if c in text else F.col(c) for c in part_cols]).distinct()


def _match_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str, null_safe: bool = True) -> DataFrame:
    """Equi-join on ``cols`` through aliases (safe when both sides share
    lineage), null-safe by default; only the left side's columns are kept."""
    lft, rgt = left.alias("_l"), right.select(*cols).alias("_r")

    def eq(c: str) -> Column:
        a, b = F.col(f"_l.`{c}`"), F.col(f"_r.`{c}`")
        return a.eqNullSafe(b) if null_safe else a == b

    cond: Column = reduce(lambda a, b: a & b, [eq(c) for c in cols])
    return lft.join(rgt, cond, how).select(*[F.col(f"_l.`{c}`").alias(c) for c in left.columns])


def restrict_to_touched(base: DataFrame, touched: DataFrame, part_cols: Sequence[str]) -> DataFrame:
    """Snapshot rows whose partition value the delta touches, by a
    list of values per column that reaches the scan as a partition filter.

    A null partition value is matched as a value (``isin`` alone never
    matches null and would drop those rows from the merge, and a dynamic
    overwrite would then lose them).
    """
    if not part_cols:
        return base
    probe = touched.select(*part_cols).collect()
    conds = []
    for i, c in enumerate(part_cols):
        vals = sorted({r[i] for r in probe if r[i] is not None})
        has_null = any(r[i] is None for r in probe)
        cond = F.col(c).isin(vals) if vals else F.lit(False)
        conds.append(cond | F.col(c).isNull() if has_null else cond)
    pruned = base.filter(reduce(lambda a, b: a & b, conds))
    if len(part_cols) == 1:
        return pruned  # the per-column filter is already exact
    # per-column lists are a superset for tuples; finish with an exact
    # semi-join against the touched tuples already on the driver, so the
    # delta pipeline is not run a second time.
    exact = base.sparkSession.createDataFrame(probe, touched.select(*part_cols).schema)
    return _match_join(pruned, exact, part_cols, "left_semi")


def align_to(df: DataFrame, like: DataFrame, fill_missing: bool = True) -> DataFrame:
    """The columns of ``like``, in its order and types (H3: partition
    values read back from paths may come typed differently). A column the
    frame lacks (one added to the landing feed later) comes as typed null
    when ``fill_missing``; otherwise it is an error, as in the reference."""
    types = {f.name: f.dataType for f in like.schema.fields}
    have = set(df.columns)
    missing = [c for c in like.columns if c not in have]
    if missing and not fill_missing:
        raise ValueError(f"snapshot lacks columns {missing}")
    return df.select(
        *[(F.col(c) if c in have else F.lit(None)).cast(types[c]).alias(c) for c in like.columns]
    )


def scd1_merge(
    delta: DataFrame,
    base: DataFrame,
    keys: Sequence[str],
    part_cols: Sequence[str],
    lexicographic: bool = False,
    global_keys: bool = False,
    touch_cols: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """P1 steps (5)-(7): full new content of the touched partitions.

    ``delta`` is a prepared delta, ``base`` the current snapshot. W2 keeps
    the row with the highest position, then the latest ``kafka_ts``; on a
    full tie the snapshot row stays, so merging the same delta twice
    changes nothing. With ``global_keys=True`` the whole snapshot takes
    part (D2 off): a key that moves partition leaves no stale row.
    ``touch_cols`` picks the partition columns that decide which snapshot
    rows take part (default all; the reference uses only the date column
    ``part_3`` of a date-partitioned table).

    ``buckets``: the base is a catalog table bucketed by ``keys`` into this
    many buckets (``sinks.tables``). The delta is hash-partitioned the same
    way, so the union keeps that partitioning and W2 runs with no exchange:
    only the delta moves, the snapshot is read bucket by bucket in place.
    """
    if buckets is not None:
        delta = delta.repartition(buckets, *[F.col(k) for k in keys])
    base = align_to(base, delta)
    if not global_keys:
        tcols = list(touch_cols or part_cols)
        base = restrict_to_touched(base, touched_partitions(delta, tcols), tcols)
    both = delta.withColumn("_src", F.lit(1)).unionByName(base.withColumn("_src", F.lit(0)))
    order = [*position_order(POS_COL, lexicographic), F.col(TS_COL).desc_nulls_last(), F.col("_src").asc()]
    return latest_per_key(both, keys, order).drop("_src")


BUCKET_COL = "key_bucket"


def key_index(snapshot: DataFrame, keys: Sequence[str], part_cols: Sequence[str], buckets: int) -> DataFrame:
    """Where each key of a snapshot lies: keys, partition values and a bucket
    of the key, by which the index is stored (``sinks.files.write_key_index``)."""
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")
    return snapshot.select(*keys, *part_cols, bucket.alias(BUCKET_COL)).distinct()


def stale_partitions(delta: DataFrame, index: DataFrame, keys: Sequence[str], part_cols: Sequence[str], buckets: int) -> DataFrame:
    """Partitions that hold a key of the delta, by the index: of the index
    only the buckets of the delta's keys are read, and of them only rows of
    those keys get past the join."""
    mine = key_index(delta, keys, [], buckets)
    wanted = [r[BUCKET_COL] for r in mine.select(BUCKET_COL).distinct().collect()]  # bucket numbers: partition metadata
    near = index.filter(F.col(BUCKET_COL).isin(wanted)) if wanted else index.limit(0)
    return touched_partitions(_match_join(near, mine, keys, "left_semi"), part_cols)


def moved_index(index: DataFrame, merged: DataFrame, keys: Sequence[str], part_cols: Sequence[str], buckets: int) -> DataFrame:
    """The index of the buckets that a merge changes, in full, to be written
    over them: keys of ``merged`` (the merge's rows) point to where they lie
    now, the other keys of those buckets stay."""
    fresh = key_index(merged, keys, part_cols, buckets)
    changed = [r[BUCKET_COL] for r in fresh.select(BUCKET_COL).distinct().collect()]
    old = index.filter(F.col(BUCKET_COL).isin(changed)) if changed else index.limit(0)
    return _match_join(old, fresh, keys, "left_anti").unionByName(fresh)


def scd1_merge_indexed(
    delta: DataFrame,
    base: DataFrame,
    index: DataFrame,
    keys: Sequence[str],
    part_cols: Sequence[str],
    buckets: int,
    lexicographic: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """P1 with keys that move partition (D2 off) and without reading the whole
    snapshot: (new content, rewritten partitions). The key index names the
    partitions that hold the delta's keys now; they are merged along with the
    delta's own, so that a moved key leaves no row behind."""
    touched = touched_partitions(delta, part_cols).unionByName(stale_partitions(delta, index, keys, part_cols, buckets)).distinct()
    touched = materialize(touched, "rewritten")  # read below and by the caller
    near = restrict_to_touched(align_to(base, delta), touched, part_cols)
    return scd1_merge(delta, near, keys, part_cols, lexicographic, global_keys=True), touched


def untouched_rows(base: DataFrame, touched: DataFrame, part_cols: Sequence[str]) -> DataFrame:
    """Snapshot rows of partitions the merge did not touch (they stay): an
    anti-join against the touched tuples (partition metadata)."""
    probe = touched.select(*part_cols)
    exact = base.sparkSession.createDataFrame(probe.collect(), probe.schema)
    return _match_join(base, exact, part_cols, "left_anti")


def apply_merge(base: DataFrame, merged: DataFrame, touched: DataFrame, part_cols: Sequence[str]) -> DataFrame:
    """The snapshot after publishing ``merged``: untouched partitions of
    ``base`` plus the merge output (touched partitions are replaced)."""
    return untouched_rows(align_to(base, merged), touched, part_cols).unionByName(merged)
