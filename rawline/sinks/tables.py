"""Snapshot kept as a catalog table bucketed by the merge keys (K1/K2 at
scale).

With the snapshot bucketed by key, ``scd1_merge(..., buckets=n)`` moves
only the delta: the touched snapshot partitions are read bucket by bucket
(``Bucketed: true`` on the scan, partition filters on the touched values)
and W2 needs no exchange. Publishing is a dynamic partition overwrite
through ``insertInto``: W2's output is already laid out like the buckets,
so it is written as is (at most one file per bucket and partition value);
touched partitions that end empty are dropped from the catalog.

Versions: a merge may also be written beside the table, bucketed alike, as
``<versions>/t=<epoch>``. Publishing it points the catalog's partitions at its
folders (``SET LOCATION``), so no row is copied; the locations from before are
kept for going back, and retention deletes versions that no partition uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .files import _match, _values, delete_path, partition_path, path_exists, registered_partitions


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _literal(v: str | None) -> str:
    """A SQL string literal of a partition value (backslash and quote
    escaped), NULL for the null partition."""
    if v is None:
        return "NULL"
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_spec(part_cols: Sequence[str], values: Sequence[str | None]) -> str:
    """The inside of a ``PARTITION (...)`` clause."""
    return ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(part_cols, values))


def bucket_count(spark: SparkSession, table: str) -> int | None:
    """Number of buckets of a catalog table (None when not bucketed)."""
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(table)}").collect():
        if r["col_name"] == "Num Buckets":
            return int(r["data_type"])
    return None


def create_bucketed_snapshot(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    part_cols: Sequence[str],
    buckets: int,
    path: str,
    fmt: str = "orc",
) -> None:
    """First publish: the snapshot as an external table at ``path``,
    partitioned by ``part_cols`` and bucketed (and sorted) by ``keys``."""
    (
        df.write.mode("overwrite")
        .format(fmt)
        .option("path", path)
        .partitionBy(*part_cols)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def publish_to_table(merged: DataFrame, table: str, part_cols: Sequence[str], touched: DataFrame) -> list[tuple]:
    """K2 for a catalog snapshot: replace the partitions ``merged`` holds
    (dynamic overwrite, bucket layout kept) and drop the touched partitions
    that ended empty. ``touched`` must be fixed before the call (it usually
    reads the table being replaced). Returns the dropped partition tuples
    (as text).

    ``merged`` may read the table it overwrites: a dynamic overwrite writes
    to a staging folder and swaps partitions in only after every task has
    succeeded, so all reads come first; no extra copy of the rows is made.
    The partition values written are gathered by an observation during the
    same write (partition metadata, as the overwrite commit itself keeps).
    """
    spark = merged.sparkSession
    seen = Observation("written_partitions")
    as_text = F.struct(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in part_cols])
    out = merged.select(*spark.table(table).columns).observe(seen, F.collect_set(as_text).alias("parts"))
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        out.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(key, old)
    ddl = ", ".join(f"`{c}` string" for c in part_cols)
    written = spark.createDataFrame([tuple(r) for r in seen.get["parts"]], ddl)

    def text(df: DataFrame) -> DataFrame:  # an empty text is stored as the null partition
        return df.select(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in part_cols])

    t, w = text(touched).alias("_t"), written.alias("_w")
    cond = None
    for c in part_cols:
        e = F.col(f"_t.`{c}`").eqNullSafe(F.col(f"_w.`{c}`"))
        cond = e if cond is None else cond & e
    empty = [tuple(r) for r in t.join(w, cond, "left_anti").distinct().collect()]
    for row in empty:
        spark.sql(f"ALTER TABLE {_quote(table)} DROP IF EXISTS PARTITION ({partition_spec(part_cols, row)})")
    spark.catalog.refreshTable(table)
    return empty


LOCATION = "location"


def write_table_version(merged: DataFrame, table: str, keys: Sequence[str], part_cols: Sequence[str], path: str) -> None:
    """A version of a bucketed table as files below ``path``, laid out like
    the table's own. The catalog entry that the bucketed write needs goes
    again; its files stay."""
    spark = merged.sparkSession
    n = bucket_count(spark, table)
    if n is None:
        raise ValueError(f"{table} is not bucketed")
    staged = f"{table}_staged"
    spark.sql(f"DROP TABLE IF EXISTS {_quote(staged)}")
    create_bucketed_snapshot(merged, staged, keys, part_cols, n, path)
    spark.sql(f"DROP TABLE {_quote(staged)}")


def partition_locations(spark: SparkSession, table: str, part_cols: Sequence[str]) -> DataFrame:
    """(partition values as text, location) of a catalog table."""
    jvm = spark.sparkContext._jvm
    name = spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(_quote(table))
    none = getattr(getattr(jvm.scala, "None$"), "MODULE$")
    found = spark._jsparkSession.sessionState().catalog().listPartitions(name, none)
    default = "__HIVE_DEFAULT_PARTITION__"
    rows = []
    for i in range(found.size()):
        part = found.apply(i)
        values = [part.spec().apply(c) for c in part_cols]
        rows.append((*[None if v in (None, default) else v for v in values], part.location().toString()))
    return spark.createDataFrame(rows, ", ".join([*(f"`{c}` string" for c in part_cols), f"{LOCATION} string"]))


def _point(spark: SparkSession, table: str, part_cols: Sequence[str], values: Sequence, at: str, listed: bool) -> None:
    spec, where = partition_spec(part_cols, values), _literal(at)
    if listed:
        spark.sql(f"ALTER TABLE {_quote(table)} PARTITION ({spec}) SET LOCATION {where}")
    else:
        spark.sql(f"ALTER TABLE {_quote(table)} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {where}")


def publish_table_version(
    spark: SparkSession, table: str, part_cols: Sequence[str], version_path: str, touched: DataFrame | None, before_path: str
) -> None:
    """P2/K2 for a bucketed table: its partitions that the version holds move
    to the version's folders, touched ones that it does not hold are dropped
    from the catalog (their files stay). ``before_path`` gets the locations
    from before, unless a stopped publish has written them. Can be repeated."""
    if not path_exists(spark, f"{before_path}/_SUCCESS"):
        partition_locations(spark, table, part_cols).write.mode("overwrite").parquet(before_path)
    held = _values(spark.read.schema(", ".join(f"`{c}` string" for c in part_cols)).orc(version_path), part_cols)
    listed = registered_partitions(spark, table, part_cols)
    a = held.alias("a").join(listed.withColumn("_in", F.lit(True)).alias("b"), _match(part_cols), "left")
    for r in a.select(*[F.col(f"a.{c}") for c in part_cols], F.col("_in").isNotNull()).collect():
        _point(spark, table, part_cols, r[:-1], partition_path(version_path, part_cols, r[:-1]), r[-1])
    if touched is not None:
        gone = _values(touched, part_cols).alias("a").join(held.alias("b"), _match(part_cols), "left_anti")
        for r in gone.collect():
            spark.sql(f"ALTER TABLE {_quote(table)} DROP IF EXISTS PARTITION ({partition_spec(part_cols, r)})")
    spark.catalog.refreshTable(table)


def roll_back_table(spark: SparkSession, table: str, part_cols: Sequence[str], before_path: str) -> None:
    """The table as it was before a publish: the kept locations again."""
    then = spark.read.parquet(before_path)
    listed = registered_partitions(spark, table, part_cols)
    for r in listed.alias("a").join(then.alias("b"), _match(part_cols), "left_anti").collect():
        spark.sql(f"ALTER TABLE {_quote(table)} DROP IF EXISTS PARTITION ({partition_spec(part_cols, r)})")
    known = {tuple(r) for r in listed.collect()}
    for r in then.collect():
        _point(spark, table, part_cols, r[:-1], r[-1], tuple(r[:-1]) in known)
    spark.catalog.refreshTable(table)


def retire_table_versions(spark: SparkSession, table: str, part_cols: Sequence[str], folders: dict[str, str]) -> list[str]:
    """Of the version folders (name -> path) delete those in which no
    partition of the table lies; returns their names."""
    used = [r[LOCATION] for r in partition_locations(spark, table, part_cols).select(LOCATION).collect()]
    free = {k: p for k, p in folders.items() if not any(f"{p.rstrip('/')}/" in u for u in used)}
    return sorted(k for k, p in free.items() if delete_path(spark, p))
