"""File sinks.

Partitioned writes use the ``rebalance`` hint on the partition columns:
rows of one partition value go to the same writers (few files per
partition), and AQE splits a partition value that is too big for one task
(a value holding a third of the table is written by many tasks) and
coalesces small ones, by measured size. ``files_per_partition`` instead
hashes each partition value into a fixed number of writers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _salted(
    df: DataFrame, part_cols: Sequence[str], files_per_partition: int | None, salt_cols: Sequence[str] | None
) -> DataFrame:
    if not part_cols:
        return df
    if files_per_partition is None:
        return df.hint("rebalance", *part_cols)
    cols = list(salt_cols) if salt_cols else df.columns
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(max(1, files_per_partition)))
    return df.repartition(*[F.col(c) for c in part_cols], salt)


def write_partitioned(
    df: DataFrame,
    path: str,
    part_cols: Sequence[str],
    fmt: str = "orc",
    mode: str = "append",
    files_per_partition: int | None = None,
    salt_cols: Sequence[str] | None = None,
    max_records_per_file: int | None = None,
) -> None:
    """K1/K3/K5: write ``df`` under ``path`` partitioned by ``part_cols``."""
    w = _salted(df, part_cols, files_per_partition, salt_cols).write.mode(mode).format(fmt)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if part_cols:
        w = w.partitionBy(*part_cols)
    w.save(path)


def publish_partitions(
    version: DataFrame,
    snapshot_path: str,
    part_cols: Sequence[str],
    touched: Sequence[tuple] | DataFrame | None = None,
    fmt: str = "orc",
    files_per_partition: int | None = None,
    keep_layout: bool = False,
) -> list[tuple]:
    """K2: replace the partitions the version holds in the snapshot
    (dynamic overwrite: other partitions keep their files). Partitions the
    merge touched but that ended empty are deleted as well, since a dynamic
    overwrite would otherwise keep their old files. Returns the deleted
    partition tuples.

    ``touched`` may be a list of tuples or a frame of the partition columns;
    the emptied ones are found by an anti-join against the version's
    partitions (compared as path text, nulls matched), so only partitions
    to delete reach the driver.

    ``keep_layout=True`` is for a version read back from its own partitioned
    folder: each file already belongs to one partition, so the rows are
    rewritten split by split with no shuffle at all.
    """
    spark = version.sparkSession
    laid_out = version if keep_layout else _salted(version, part_cols, files_per_partition, None)
    (
        laid_out
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .format(fmt)
        .partitionBy(*part_cols)
        .save(snapshot_path)
    )
    if touched is None:
        return []
    ddl = ", ".join(f"`{c}` string" for c in part_cols)
    if not isinstance(touched, DataFrame):
        if not touched:
            return []
        touched = spark.createDataFrame([_as_text(t) for t in touched], ddl)

    def text(df: DataFrame) -> DataFrame:  # an empty text is stored as the null partition
        return df.select(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in part_cols])

    t, w = text(touched).alias("_t"), text(version).distinct().alias("_w")
    cond = None
    for c in part_cols:
        e = F.col(f"_t.`{c}`").eqNullSafe(F.col(f"_w.`{c}`"))
        cond = e if cond is None else cond & e
    empty = [tuple(r) for r in t.join(w, cond, "left_anti").distinct().collect()]
    for row in empty:
        delete_path(spark, partition_path(snapshot_path, part_cols, row))
    return empty


def count_rows(written: DataFrame) -> int:
    """A1/P5: rows of committed files. No column is read, only the counts in
    the files' footers; unlike an observation on the way to a shuffle, a task
    that runs again cannot add to it."""
    return written.count()


def write_quarantine(bad: DataFrame, path: str) -> None:
    """Quarantined landing lines by batch; a batch read again replaces its lines."""
    (
        bad.hint("rebalance", "batchno")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batchno")
        .orc(path)
    )


def write_key_index(index: DataFrame, path: str, bucket_col: str = "key_bucket") -> None:
    """A key index by bucket of the key; buckets that ``index`` holds are replaced."""
    (
        index.hint("rebalance", bucket_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(bucket_col)
        .orc(path)
    )


def _as_text(values: Sequence) -> tuple:
    return tuple(None if v is None else str(v) for v in values)


def partition_path(root: str, part_cols: Sequence[str], values: Sequence) -> str:
    """Directory that Spark writes one partition tuple to (its own escaping;
    null and empty text give the default name)."""
    jvm = SparkSession.active().sparkContext._jvm
    name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join((root.rstrip("/"), *(name(c, None if v is None else str(v)) for c, v in zip(part_cols, values))))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete of a folder (a version or a partition)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a folder (S3 listing); [] if absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def export_by_type(
    df: DataFrame,
    out: str,
    type_col: str = "gst_type",
    files_per_type: int | None = None,
    max_records_per_file: int | None = None,
) -> None:
    """K9/P10: CSV (with header) per type, all types in one job. By default
    a type is one file unless it is too big for one task (rebalance);
    ``files_per_type=1`` forces exactly one writer per type."""
    w = _salted(df, [type_col], files_per_type, None).write.mode("overwrite").option("header", True)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.partitionBy(type_col).csv(out)


def rename_path(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    return bool(fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)))


def name_type_folders(spark: SparkSession, out: str, type_col: str, name_of) -> list[str]:
    """P10: rename each ``<type_col>=<value>`` folder of an export to
    ``name_of(value)`` (the null type's folder gets ``name_of(None)``).
    One metadata rename per type."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    done = []
    for child in list_children(spark, out):
        if not child.startswith(f"{type_col}="):
            continue
        raw = child.split("=", 1)[1]
        value = None if raw == "__HIVE_DEFAULT_PARTITION__" else unescape(raw)
        target = f"{out.rstrip('/')}/{name_of(value)}"
        if rename_path(spark, f"{out.rstrip('/')}/{child}", target):
            done.append(target)
    return sorted(done)


def write_json_by(df: DataFrame, out: str, part_cols: Sequence[str]) -> None:
    """K6: JSON, replacing only the partitions present in ``df``."""
    (
        df.hint("rebalance", *part_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*part_cols)
        .json(out)
    )


def append_csv(df: DataFrame, out: str, header: bool = False) -> None:
    """K7/K8: append CSV files (summary rows are one small file)."""
    df.write.mode("append").option("header", header).csv(out)


def register_new_partitions(spark: SparkSession, table: str, part_cols: Sequence[str], path: str) -> list[tuple]:
    """Register the partitions below ``path`` that the catalog's list of
    ``table`` lacks, at their folders, and drop the listed ones that are no
    longer there. Only the difference reaches the driver; returns what was added."""
    from .tables import partition_spec

    ddl = ", ".join(f"`{c}` string" for c in part_cols)
    there = _values(spark.read.schema(ddl).orc(path), part_cols) if path_exists(spark, path) else spark.createDataFrame([], ddl)
    listed = registered_partitions(spark, table, part_cols)
    cond = _match(part_cols)
    new = [tuple(r) for r in there.alias("a").join(listed.alias("b"), cond, "left_anti").collect()]
    gone = [tuple(r) for r in listed.alias("a").join(there.alias("b"), cond, "left_anti").collect()]
    name = ".".join(f"`{p}`" for p in table.split("."))
    for row in new:
        at = partition_path(path, part_cols, row).replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({partition_spec(part_cols, row)}) LOCATION '{at}'")
    for row in gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition_spec(part_cols, row)})")
    spark.catalog.refreshTable(table)
    return new


def registered_partitions(spark: SparkSession, table: str, part_cols: Sequence[str]) -> DataFrame:
    """The catalog's partition list as a frame of the partition columns
    (text; the default name is null)."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    name = ".".join(f"`{p}`" for p in table.split("."))

    def value(pair: str) -> str | None:
        text = pair.split("=", 1)[1]
        return None if text == "__HIVE_DEFAULT_PARTITION__" else unescape(text)

    specs = [r["partition"].split("/") for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    return spark.createDataFrame([tuple(value(p) for p in s) for s in specs], ", ".join(f"`{c}` string" for c in part_cols))


def _values(df: DataFrame, part_cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in part_cols]).distinct()


def _match(part_cols: Sequence[str]):
    cond = F.lit(True)
    for c in part_cols:
        cond = cond & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return cond


def append_table(df: DataFrame, table: str) -> None:
    """K4: append to a catalog table (created on first use)."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df.write.insertInto(table)
    else:
        df.write.mode("append").saveAsTable(table)
