"""Snapshot behind a manifest: publishing moves one pointer.

Version folders ``t=<epoch>/<partitions>`` stay where the merge wrote them. A
manifest is a table (folder, partition values): one row per live partition,
naming the version folder that holds it. Publishing a version writes the next
manifest (the rows of partitions that the version rewrote are replaced, those
that it emptied go) and then renames one small file over the pointer. Readers
see the old snapshot or the new one, whatever step a run stopped at, and no
row is copied.

Layout: ``<root>/_manifest/n=<number>/*.parquet`` and ``<root>/_manifest/CURRENT``.
One publisher per table at a time; the rename is atomic where the file system
renames atomically (HDFS, local; not plain object stores).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import _fs, _match, _values, delete_path, list_children, partition_path, path_exists

FOLDER = "folder"


@dataclass
class Pointer:
    """What the pointer file says: the live manifest, the last version in it
    and the rows that this publish brought."""

    number: int
    upto: int
    rows: int


def _dir(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def read_pointer(spark: SparkSession, root: str) -> Pointer | None:
    path = f"{_dir(root)}/CURRENT"
    if not path_exists(spark, path):
        return None
    return Pointer(**json.loads(spark.read.text(path, wholetext=True).first()["value"]))


def switch_pointer(spark: SparkSession, root: str, pointer: Pointer) -> None:
    """The publish itself: one rename that replaces the pointer file."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs, new = _fs(spark, f"{_dir(root)}/CURRENT.next")
    out = fs.create(new, True)
    try:
        out.write(bytearray(json.dumps(asdict(pointer)).encode()))
    finally:
        out.close()
    option = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    option[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(f"{_dir(root)}/CURRENT")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(new), fs.makeQualified(target), option)


def _ddl(part_cols: Sequence[str]) -> str:
    return ", ".join([f"{FOLDER} string", *(f"`{c}` string" for c in part_cols)])


def read_manifest(spark: SparkSession, root: str, part_cols: Sequence[str], number: int | None = None) -> DataFrame:
    """(folder, partition values as text) of a manifest, the live one by
    default. A table that was published into ``t=0`` before has its
    partitions there as its first manifest."""
    if number is None:
        now = read_pointer(spark, root)
        if now is None:
            legacy = f"{root.rstrip('/')}/t=0"
            if not path_exists(spark, legacy):
                return spark.createDataFrame([], _ddl(part_cols))
            there = _values(spark.read.schema(", ".join(f"`{c}` string" for c in part_cols)).orc(legacy), part_cols)
            return there.select(F.lit("t=0").alias(FOLDER), *part_cols)
        number = now.number
    return spark.read.schema(_ddl(part_cols)).parquet(f"{_dir(root)}/n={number}")


def next_manifest(
    spark: SparkSession, root: str, part_cols: Sequence[str], version: DataFrame, folder: str, touched: DataFrame | None
) -> DataFrame:
    """The manifest after ``folder`` takes over the partitions that
    ``version`` holds; touched partitions that it does not hold are gone."""
    held = _values(version, part_cols)
    gone = held if touched is None else held.unionByName(_values(touched, part_cols)).distinct()
    stay = read_manifest(spark, root, part_cols).alias("a").join(gone.alias("b"), _match(part_cols), "left_anti")
    return stay.unionByName(held.select(F.lit(folder).alias(FOLDER), *part_cols))


def write_manifest(manifest: DataFrame, root: str, number: int) -> None:
    """Write manifest ``number`` (left-overs of a stopped run are replaced)."""
    manifest.write.mode("overwrite").parquet(f"{_dir(root)}/n={number}")


def read_published(spark: SparkSession, root: str, schema: StructType, part_cols: Sequence[str], number: int | None = None) -> DataFrame:
    """The snapshot of a manifest: ``schema`` includes the partition columns.
    The list of folders is partition metadata, as a folder listing is; filters
    on partition columns prune among them."""
    rows = read_manifest(spark, root, part_cols, number).collect()
    if not rows:
        return spark.createDataFrame([], schema)
    paths = [partition_path(f"{root.rstrip('/')}/{r[FOLDER]}", part_cols, [r[c] for c in part_cols]) for r in rows]
    return spark.read.schema(schema).option("basePath", root).orc(paths).select(*schema.names)


def live_folders(spark: SparkSession, root: str, part_cols: Sequence[str], keep: int = 1) -> DataFrame:
    """(folder, partition values) that the last ``keep`` manifests name."""
    now = read_pointer(spark, root)
    if now is None:
        return spark.createDataFrame([], _ddl(part_cols))
    there = [k for k in range(max(1, now.number - keep + 1), now.number + 1) if path_exists(spark, f"{_dir(root)}/n={k}")]
    return spark.read.schema(_ddl(part_cols)).parquet(*[f"{_dir(root)}/n={k}" for k in there]).distinct()


def retire(spark: SparkSession, root: str, part_cols: Sequence[str], folders: Sequence[str], keep: int = 1) -> list[str]:
    """P3 behind a manifest: delete what no kept manifest names. Of the given
    version folders those without a live partition go whole (returned); of the
    others only the partitions that a later version replaced. Manifests older
    than the kept ones go too."""
    live = live_folders(spark, root, part_cols, keep)
    still = {r[FOLDER] for r in live.select(FOLDER).distinct().collect()}
    base = root.rstrip("/")
    gone = [f for f in folders if f not in still and delete_path(spark, f"{base}/{f}")]
    for f in folders:
        if f in still and path_exists(spark, f"{base}/{f}"):
            parts = _values(spark.read.schema(", ".join(f"`{c}` string" for c in part_cols)).orc(f"{base}/{f}"), part_cols)
            used = live.filter(F.col(FOLDER) == f)
            for r in parts.alias("a").join(used.alias("b"), _match(part_cols), "left_anti").collect():
                delete_path(spark, partition_path(f"{base}/{f}", part_cols, list(r)))
    now = read_pointer(spark, root)
    for name in list_children(spark, _dir(root)):
        if name.startswith("n=") and now is not None and int(name[2:]) <= now.number - keep:
            delete_path(spark, f"{_dir(root)}/{name}")
    return gone


def roll_back(spark: SparkSession, root: str, number: int) -> None:
    """Make an earlier manifest live again, as long as it was kept."""
    now = read_pointer(spark, root)
    if now is None or not path_exists(spark, f"{_dir(root)}/n={number}"):
        raise ValueError(f"no manifest {number} below {root}")
    switch_pointer(spark, root, Pointer(number, now.upto, now.rows))
