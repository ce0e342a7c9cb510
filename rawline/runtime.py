"""Session-level helpers: the shared scratch folder and lineage cuts.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(a path every executor can reach). We only pick our own folder when the
session has none, which is the case in unit tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch root: ``spark.checkpoint.dir`` or the
    context's checkpoint dir. With neither, a local-mode session gets a temp
    folder (driver and executors are one process there); on a cluster that
    is an error, as executors could not share it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="rawline-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a reliable directory."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark) + "/rdd")
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder (never reused)."""
    return f"{shared_dir(spark)}/rawline/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss (unlike a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back. Later
    plans read columns of it instead of running it again, and a lost executor
    takes nothing with it (unlike ``persist``)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Shuffle sizing: one initial shuffle partition per this much input (the
# size of a default file split); AQE coalesces small partitions afterwards
# and splits skewed ones, but it never raises the initial count.
INPUT_BYTES_PER_PARTITION = 128 * 1024 * 1024


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes stored under ``paths`` (file-system metadata, no data read);
    missing paths count as 0."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += int(fs.getContentSummary(hp).getLength())
    return total


def wanted_shuffle_partitions(
    n_bytes: int,
    current: int,
    bytes_per_partition: int = INPUT_BYTES_PER_PARTITION,
) -> int:
    """Initial shuffle partitions for ``n_bytes`` of input: one per
    ``bytes_per_partition``, never below ``current``."""
    return max(current, -(-max(0, n_bytes) // bytes_per_partition))


def size_shuffle_partitions(spark: SparkSession, n_bytes: int) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to fit a run over ``n_bytes``
    of input, unless the launcher set it (then it is kept as given).
    Returns the value in effect."""
    key = "spark.sql.shuffle.partitions"
    current = int(spark.conf.get(key))
    if spark.sparkContext.getConf().contains(key):
        return current
    wanted = wanted_shuffle_partitions(n_bytes, current)
    if wanted != current:
        spark.conf.set(key, str(wanted))
    return wanted


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rawline`` importable in Python workers (for mapInPandas and
    pandas UDFs): zip the package once per application in memory, write it
    into the shared folder through the Hadoop file system and ``addPyFile``
    it from there, as ``--py-files`` would (no machine-local temp folder)."""
    import io
    import os
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.join("rawline", os.path.relpath(full, pkg_dir)))
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "pyfiles") + "/rawline.zip")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    spark.sparkContext.addPyFile(fs.makeQualified(path).toString())
    _SHIPPED.add(app)
