"""Landing and snapshot readers.

Landing layout: ``<root>/L_<table>/batchno=<yyyyMMddHHmmss>/*.json``.
Raw layout: ``<root>/R_<table>/t=<version>/<part_1=...>[/...]/*.orc``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.batch_ids import is_valid_batch_id
from ..runtime import scratch_path
from ..sinks.files import count_rows, list_children


def landing_dir(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/L_{table}"


def raw_dir(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/R_{table}"


def quarantine_dir(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/Q_{table}"


def sample_schema(spark: SparkSession, sample_path: str) -> StructType:
    """Schema of a sample landing file."""
    return spark.read.json(sample_path).schema


def merged_schema(spark: SparkSession, landing_root: str, batches: Sequence[str]) -> StructType:
    """S2/U1 under schema drift: the schema that all lines of the chosen
    batches fit. A field that changes between them is widened (integer,
    decimal, double) or, where its types have nothing wider in common, read as
    text; a field that some batches lack is null there. One pass that infers
    and merges types in the tasks; unreadable lines have no say."""
    root = landing_root.rstrip("/")
    reader = spark.read.option("basePath", root).option("prefersDecimal", True).option("mode", "DROPMALFORMED")
    found = reader.json([f"{root}/batchno={b}" for b in batches]).schema
    return StructType([f for f in found.fields if f.name != "batchno"])


def list_batches(spark: SparkSession, landing_root: str) -> DataFrame:
    """S3 + N21: the landing batch directories as a one-column table
    ``batchno`` (string). Only names that are valid batch ids are kept
    (D19). Listing one folder level is driver metadata, not data."""
    names = [n for n in list_children(spark, landing_root) if "=" in n]
    rows = [(last_path_part_text(n),) for n in names]
    schema = StructType([StructField("batchno", StringType())])
    df = spark.createDataFrame(rows, schema)
    return df.filter(is_valid_batch_id(F.col("batchno")))


def last_path_part_text(name: str) -> str:
    return name.split("=")[-1]


def read_landing(
    spark: SparkSession,
    landing_root: str,
    schema: StructType,
    batches: Sequence[str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """One read over the chosen batch folders (no per-batch loop).

    ``batchno`` is declared in the read schema, so partition discovery keeps
    it as text. Without ``batches`` the whole landing tree is read and a
    filter on ``batchno`` prunes partitions instead.
    """
    root = landing_root.rstrip("/")
    full = StructType([f for f in schema.fields if f.name != "batchno"] + [StructField("batchno", StringType())])
    reader = spark.read.schema(full).option("basePath", root).option("multiLine", multiline)
    if batches is None:
        return reader.json(root)
    paths = [f"{root}/batchno={b}" for b in batches]
    if not paths:
        return spark.createDataFrame([], full)
    return reader.json(paths)


#: Why a landing line is kept out of the merge.
UNREADABLE, NO_CAST, NULL_KEY = "unreadable", "value does not cast", "null key"
QUARANTINE_DDL = "line string, reason string, batchno string"
_CORRUPT = "_corrupt_line"


def read_lines(spark: SparkSession, landing_root: str, batches: Sequence[str]) -> DataFrame:
    """(value, batchno): the raw lines of the chosen batch folders, blank lines left out."""
    root = landing_root.rstrip("/")
    if not batches:
        return spark.createDataFrame([], "value string, batchno string")
    lines = spark.read.schema("value string, batchno string").option("basePath", root).text([f"{root}/batchno={b}" for b in batches])
    return lines.filter(F.col("value").rlike(r"\S"))


def parse_lines(lines: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """S1 with every line accounted for: the columns of ``schema``, ``batchno``,
    and ``line`` and ``reason`` of a line that cannot take part (null for the
    others): no object can be read from it, a value does not cast to the
    schema, or a key is null.

    Lines are parsed by an expression, not by the JSON source, which checks
    only the columns that a plan happens to read."""
    fields = [f for f in schema.fields if f.name not in ("batchno", "line", "reason", _CORRUPT)]
    full = StructType([*fields, StructField(_CORRUPT, StringType())])
    parsed = lines.withColumn("_r", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    is_object = F.coalesce(F.get_json_object("value", "$").startswith("{"), F.lit(False))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(f"_r.`{k}`").isNull()
    reason = (
        F.when(~is_object, UNREADABLE)
        .when(F.col("_r").isNull() | F.col(f"_r.{_CORRUPT}").isNotNull(), NO_CAST)
        .when(null_key, NULL_KEY)
    )
    parsed = parsed.withColumn("reason", reason)
    return parsed.select(
        *[F.col(f"_r.`{f.name}`").alias(f.name) for f in fields], "batchno",
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("line"), "reason",
    )


@dataclass
class StagedLanding:
    """The lines of a run, parsed once and kept in the shared folder."""

    good: DataFrame
    quarantined: DataFrame
    n_good: int
    n_quarantined: int


def stage_landing(
    spark: SparkSession, landing_root: str, schema: StructType, batches: Sequence[str], keys: Sequence[str]
) -> StagedLanding:
    """S1/U1 through the quarantine: one pass over the chosen batch folders
    writes good and bad lines apart; both counts come from the committed files,
    and together they are the lines that the folders held."""
    parsed = parse_lines(read_lines(spark, landing_root, batches), schema, keys)
    path = scratch_path(spark, "landing")
    state = F.when(F.col("reason").isNull(), "good").otherwise("bad")
    parsed.withColumn("state", state).write.partitionBy("state").orc(path)
    whole = StructType([f for f in parsed.schema.fields])

    def part(name: str) -> DataFrame:
        there = f"state={name}" in list_children(spark, path)
        return spark.read.schema(whole).orc(f"{path}/state={name}") if there else spark.createDataFrame([], whole)

    good, bad = part("good").drop("line", "reason"), part("bad").select("line", "reason", "batchno")
    return StagedLanding(good, bad, count_rows(good), count_rows(bad))


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """ORC with a declared schema, partition columns included, so
    ``part_1=012`` stays the text "012" (H3)."""
    return spark.read.schema(schema).orc(path)


def list_versions(spark: SparkSession, raw_root: str) -> DataFrame:
    """Versions ``t`` present under a raw table (folder names only)."""
    names = [n for n in list_children(spark, raw_root) if n.startswith("t=")]
    vals = []
    for n in names:
        text = last_path_part_text(n)
        if text.isdigit():
            vals.append((int(text),))
    return spark.createDataFrame(vals, "t bigint")
