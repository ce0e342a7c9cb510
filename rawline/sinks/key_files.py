"""Snapshot whose manifest lists files with their key bounds.

A partition is written as files of disjoint key ranges, sorted by key, with an
ORC Bloom filter on the key. The manifest is a table with one row per live file
(file, partition values, lowest and highest key, rows). A merge reads the files
of the touched partitions that hold a key of the delta, writes their new content
and the new keys to a version folder, and publishes a manifest in which these
files are replaced. All other files stay where they are, also those of the same
partition: a hot partition is neither read nor shuffled whole for a small delta.
Rows of keys that the delta does not hold are not looked at, so where a key has
rows in several partitions, a merge clears them only with a delta of that key
(the merge of whole partitions also clears others that it comes across).

Files are found in three steps, each of which only leaves out files that cannot
hold a key of the delta: by bounds against ranges of the delta's keys (manifest
rows only), by Bloom filters and row-group bounds inside the ORC reader, and by
a semi-join over the key columns of what is left.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.scd import restrict_to_touched, scd1_merge, touched_partitions
from ..runtime import materialize
from .files import delete_path, list_children
from .manifest import Pointer, read_pointer, switch_pointer, write_manifest

#: Ranges that a delta's keys are summed up in, and the most keys that go to the
#: ORC reader as a list (for its Bloom filters; beyond it their bounds go). Both
#: only decide how much is left out early, never which files are found.
RANGES, LISTED = 200, 10_000
ROWS_PER_FILE = 2_000_000


def write_by_key(df: DataFrame, path: str, keys: Sequence[str], part_cols: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``df`` in files of disjoint key ranges per partition value; a hot
    value is range-partitioned over many tasks."""
    by = [*part_cols, *keys]
    (
        df.repartitionByRange(*[F.col(c) for c in by])
        .sortWithinPartitions(*by)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option("orc.bloom.filter.columns", ",".join(keys))
        .partitionBy(*part_cols)
        .orc(path)
    )


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k).alias(k) for k in keys])


def file_bounds(files: DataFrame, keys: Sequence[str], part_cols: Sequence[str]) -> DataFrame:
    """(file, partition values, low, high, n_rows) of a frame over files; only
    the key columns are read, and each task sums up its files first."""
    named = files.select(F.col("_metadata.file_path").alias("file"), *part_cols, _key(keys).alias("k"))
    return named.groupBy("file", *part_cols).agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count(F.lit(1)).alias("n_rows"))


def read_bounds(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The live manifest, or an earlier one."""
    number = read_pointer(spark, root).number if number is None else number
    return spark.read.parquet(f"{root.rstrip('/')}/_manifest/n={number}")


def read_files(spark: SparkSession, root: str, schema: StructType, files: Sequence[str]) -> DataFrame:
    """Rows of the named files; partition columns come from their paths."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).orc([unquote(f) for f in files])


def read_key_snapshot(spark: SparkSession, root: str, schema: StructType, number: int | None = None) -> DataFrame:
    """The snapshot; the list of files is partition metadata."""
    files = [r["file"] for r in read_bounds(spark, root, number).select("file").collect()]
    return read_files(spark, root, schema, files).select(*schema.names)  # without the version folder


def key_ranges(delta: DataFrame, keys: Sequence[str], ranges: int = RANGES) -> list[tuple]:
    """At most ``ranges`` disjoint (low, high) that cover the delta's keys."""
    dealt = delta.select(_key(keys).alias("k")).repartitionByRange(ranges, "k")
    got = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("low"), F.max("k").alias("high")).collect()
    return [(tuple(r["low"]), tuple(r["high"])) for r in got]


def may_hold(bounds: DataFrame, delta: DataFrame, keys: Sequence[str], part_cols: Sequence[str]) -> DataFrame:
    """Files of the touched partitions whose bounds meet the delta's keys."""
    types = {f.name: f.dataType for f in delta.schema.fields}

    def lit(values: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(types[k]).alias(k) for k, v in zip(keys, values)])

    near = restrict_to_touched(bounds, touched_partitions(delta, part_cols), part_cols)
    spans = [F.struct(lit(a).alias("a"), lit(b).alias("b")) for a, b in key_ranges(delta, keys)]
    if not spans:
        return near.limit(0)
    return near.filter(F.exists(F.array(*spans), lambda r: (F.col("low") <= r["b"]) & (F.col("high") >= r["a"])))


def key_rows(spark: SparkSession, root: str, schema: StructType, files: Sequence[str], delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(file, keys): rows of the files that hold a key of the delta. Of the
    files only the key columns are read, and of these only what the reader's
    row-group bounds and Bloom filters let through."""
    there = read_files(spark, root, schema, files)
    mine = delta.select(*keys).distinct()
    few = mine.limit(LISTED + 1).collect()
    for k in keys:
        values = [r[k] for r in few if r[k] is not None]
        if len(few) <= LISTED:
            there = there.filter(F.col(k).isin(values) | F.col(k).isNull() if len(values) < len(few) else F.col(k).isin(values))
        else:
            low, high, nulls = delta.agg(F.min(k), F.max(k), F.count(F.when(F.col(k).isNull(), 1))).first()
            within = F.col(k).between(low, high)
            there = there.filter(within | F.col(k).isNull() if nulls else within)
    named = there.select(F.col("_metadata.file_path").alias("file"), *keys).alias("t")
    wanted = mine.select(*[F.col(k).alias(f"d{i}") for i, k in enumerate(keys)])
    same = [F.col(f"t.`{k}`").eqNullSafe(F.col(f"d{i}")) for i, k in enumerate(keys)]
    return named.join(wanted, same, "left_semi")


def files_holding(spark: SparkSession, root: str, schema: StructType, delta: DataFrame, keys: Sequence[str], part_cols: Sequence[str]) -> list[str]:
    """Files of the touched partitions that hold a key of the delta."""
    near = [r["file"] for r in may_hold(read_bounds(spark, root), delta, keys, part_cols).select("file").collect()]
    if not near:
        return []
    return sorted(r["file"] for r in key_rows(spark, root, schema, near, delta, keys).select("file").distinct().collect())


def publish_files(spark: SparkSession, root: str, version: DataFrame, gone: Sequence[str], epoch: int, keys: Sequence[str], part_cols: Sequence[str]) -> None:
    """Publish the version written to ``t=<epoch>`` in place of the files
    ``gone``: the next manifest, then one rename of the pointer."""
    now = read_pointer(spark, root)
    fresh = file_bounds(version, keys, part_cols)
    if now is not None:
        old = spark.createDataFrame([(f,) for f in gone], "gone string")
        stay = read_bounds(spark, root).join(old, F.col("file") == F.col("gone"), "left_anti")
        fresh = stay.unionByName(fresh)
    number = 1 if now is None else now.number + 1
    write_manifest(fresh, root, number)
    rows = spark.read.parquet(f"{root.rstrip('/')}/_manifest/n={number}").agg(F.sum("n_rows")).first()[0]
    switch_pointer(spark, root, Pointer(number, epoch, int(rows or 0)))


def start_key_snapshot(snapshot: DataFrame, root: str, epoch: int, keys: Sequence[str], part_cols: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """The first version of a snapshot in this layout."""
    spark = snapshot.sparkSession
    write_by_key(snapshot, f"{root}/t={epoch}", keys, part_cols, rows_per_file)
    publish_files(spark, root, _version(spark, root, snapshot.schema, epoch), [], epoch, keys, part_cols)


def _version(spark: SparkSession, root: str, schema: StructType, epoch: int) -> DataFrame:
    return spark.read.schema(schema).option("basePath", f"{root}/t={epoch}").orc(f"{root}/t={epoch}")


def merge_key_files(
    delta: DataFrame,
    root: str,
    epoch: int,
    keys: Sequence[str],
    part_cols: Sequence[str],
    lexicographic: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
) -> list[str]:
    """P1 and P2 on this layout: merge a prepared delta and publish; returns
    the files that were replaced. A repeated run of an epoch that is published
    already does nothing; one that stopped before starts anew."""
    spark = delta.sparkSession
    now = read_pointer(spark, root)
    if now is not None and now.upto >= epoch:
        return []
    delta = materialize(delta, "delta")
    hit = files_holding(spark, root, delta.schema, delta, keys, part_cols)
    merged = scd1_merge(delta, read_files(spark, root, delta.schema, hit), keys, part_cols, lexicographic, global_keys=True)
    write_by_key(merged, f"{root}/t={epoch}", keys, part_cols, rows_per_file)
    publish_files(spark, root, _version(spark, root, delta.schema, epoch), hit, epoch, keys, part_cols)
    return hit


def retire_files(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete the files of versions that none of the last ``keep``
    manifests names, and the manifests before them; returns the files."""
    now = read_pointer(spark, root)
    live = {f["file"] for n in range(max(1, now.number - keep + 1), now.number + 1) for f in read_bounds(spark, root, n).select("file").collect()}
    before = [int(m[2:]) for m in list_children(spark, f"{root}/_manifest") if m.startswith("n=") and int(m[2:]) <= now.number - keep]
    gone = sorted({f["file"] for n in before for f in read_bounds(spark, root, n).select("file").collect()} - live)
    for f in gone:
        delete_path(spark, unquote(f))
    for n in before:
        delete_path(spark, f"{root}/_manifest/n={n}")
    return gone
