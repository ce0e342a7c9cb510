"""Typed job configs read from one JSON document (S6, J3, J10f).

The document is read with an explicit schema as a one-row frame; the rule
list is exploded and filtered as a DataFrame, then brought back as a
short list of rules (config, not data).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import ColumnRule
from .sources.files import read_json_doc

RAW_PIPELINE_SCHEMA = (
    "rawpipeline struct<appname string, tablename string, sourcepath string, stagingpath string, "
    "targetpath string, startbatchno string, endbatchno string, scd1column string, selectcols string, "
    "schemafile string, date_partitioned boolean, "
    "additional_columns array<struct<columnkey string, columnname string, columnformula string>>>"
)


def rule_table(config: DataFrame, path: str = "rawpipeline.additional_columns") -> DataFrame:
    """N13/J3/J10f: one row per rule entry; null or empty lists give no
    rows, entries with a null key or name are dropped."""
    return (
        config.select(F.explode(F.col(path)).alias("r"))
        .select("r.columnkey", "r.columnname", "r.columnformula")
        .filter(F.col("columnkey").isNotNull() & F.col("columnname").isNotNull())
    )


@dataclass
class RawPipelineConfig:
    """The ``rawpipeline`` section of the landing -> raw job."""

    appname: str
    tablename: str
    sourcepath: str
    targetpath: str
    keys: list[str]
    selectcols: list[str]
    rules: list[ColumnRule] = field(default_factory=list)
    startbatchno: str | None = None
    endbatchno: str | None = None
    stagingpath: str | None = None
    schemafile: str | None = None
    date_partitioned: bool = False

    @classmethod
    def from_json(cls, spark: SparkSession, path: str) -> RawPipelineConfig:
        doc = read_json_doc(spark, path, RAW_PIPELINE_SCHEMA)
        row = doc.select("rawpipeline.*").first()
        if row is None:
            raise ValueError(f"empty config {path}")
        rules = [ColumnRule(*r) for r in rule_table(doc).collect()]
        return cls(
            appname=row["appname"],
            tablename=row["tablename"],
            sourcepath=row["sourcepath"],
            targetpath=row["targetpath"],
            keys=[c.strip() for c in (row["scd1column"] or "").split(",") if c.strip()],
            selectcols=[c.strip() for c in (row["selectcols"] or "").split(",") if c.strip()],
            rules=rules,
            startbatchno=row["startbatchno"],
            endbatchno=row["endbatchno"],
            stagingpath=row["stagingpath"],
            schemafile=row["schemafile"],
            date_partitioned=bool(row["date_partitioned"]),
        )


@dataclass
class ExternalConfig:
    """The ``externalpipeline`` section of the trusted -> external job."""

    app_name: str
    table_name: str
    statuspath: str
    errorpath: str
    param1: str = "param1"
    param2: str = "param2"
    fromdate: str | None = None

    @classmethod
    def from_json(cls, spark: SparkSession, path: str) -> ExternalConfig:
        """The ``externalpipeline`` section of a JSON document; missing
        required settings raise (D6)."""
        ddl = (
            "externalpipeline struct<app_name string, table_name string, statuspath string, "
            "errorpath string, errorTable struct<path string, name string>, param1 string, param2 string, fromdate string>"
        )
        row = read_json_doc(spark, path, ddl).select("externalpipeline.*").first()
        if row is None:
            raise ValueError(f"empty config {path}")
        errorpath = row["errorpath"] or (row["errorTable"] or {"path": None})["path"]
        missing = [k for k in ("app_name", "table_name", "statuspath") if not row[k]]
        if not errorpath:
            missing.append("errorTable.path")
        if missing:
            raise ValueError(f"externalpipeline lacks {missing} in {path}")
        return cls(
            app_name=row["app_name"],
            table_name=row["table_name"],
            statuspath=row["statuspath"],
            errorpath=errorpath,
            param1=row["param1"] or "param1",
            param2=row["param2"] or "param2",
            fromdate=row["fromdate"],
        )
