"""Config, text and CSV readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_json_doc(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One (possibly multi-line) JSON document as a one-row frame."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_query_text(spark: SparkSession, path: str) -> str:
    """The whole query file as one string (D9: not only line one)."""
    row = spark.read.text(path, wholetext=True).first()
    return row[0] if row is not None else ""


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    header: bool = True,
    sep: str = ",",
) -> DataFrame:
    """CSV with a declared schema (no inference pass over the
    data); D8: a header row is expected by default."""
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(path)


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


# Fixed values that must equal the reference's (session log column names).
SESSION_COLUMNS = [
    "COMPANY1",
    "BUSSINESSPALCE1",
    "GSTIN1",
    "FP1",
    "SECTION1",
    "USER1",
    "APPKEY",
    "SEK",
    "AUTHTOKEN",
    "TEMP",
]


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Headerless 10-column session log, all text, named by position."""
    ddl = ", ".join(f"_c{i} string" for i in range(len(SESSION_COLUMNS)))
    return rename_positional(read_csv(spark, path, ddl, header=False), SESSION_COLUMNS)
