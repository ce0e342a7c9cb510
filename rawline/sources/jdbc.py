"""JDBC source.

The extract query is wrapped as a derived table; for large sources the
read is split into ``num_partitions`` range scans on a numeric column so
the executors pull in parallel instead of one task reading everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.batches import substitute_mark

# Fixed values that must equal the reference's (environment -> source).
SOURCE_BY_ENV = {"DEV": "HDV", "PREPRD": "HDV", "PRD": "HANA"}


def source_for_env(env: str) -> str | None:
    """Which source system an environment extracts from."""
    return SOURCE_BY_ENV.get(env)


def derived_table(query: str, mark: str, alias: str = "temp_alias") -> str:
    """The query with the mark put in, as a JDBC ``dbtable`` value."""
    return f"({substitute_mark(query, mark)}) {alias}"


def jdbc_options(
    url: str,
    dbtable: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetchsize: int = 10000,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": dbtable, "fetchsize": str(fetchsize)}
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            opts[k] = v
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_jdbc_query(spark: SparkSession, query: str, mark: str, **kw) -> DataFrame:
    """Incremental extract through JDBC. Filters applied on the result
    (e.g. the COD flag) are pushed to the database by Spark."""
    return spark.read.format("jdbc").options(**jdbc_options(dbtable=derived_table(query, mark), **kw)).load()
