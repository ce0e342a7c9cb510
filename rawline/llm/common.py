"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawline.runtime import scratch_path, ship_package

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives lost executors and gives later plans real sizes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ready(spark: SparkSession) -> None:
    """Make the package importable in Python workers."""
    ship_package(spark)


def n_words(text: Column) -> Column:
    """Number of words in ``text`` (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: Column, text: Column) -> Column:
    """Key of a document row. Rows that repeat both doc_id and text share it
    and are the same document. Rows are told apart by doc_id and key together:
    by the key alone, some of very many rows would meet by chance."""
    return F.xxhash64(doc_id, text)


def same_id(a: Column, b: Column) -> Column:
    """Equal doc_ids, or both null; beside equal row keys in a join, which stays
    dealt by the row key alone."""
    return F.coalesce(a == b, a.isNull() & b.isNull())


def free_names(names: list[str], taken: list[str]) -> list[str]:
    """``names`` for added columns; one that a frame has already (in any case)
    gets underscores in front until it is free."""
    used = {c.lower() for c in taken}
    out = []
    for n in names:
        while n.lower() in used:
            n = "_" + n
        used.add(n.lower())
        out.append(n)
    return out
