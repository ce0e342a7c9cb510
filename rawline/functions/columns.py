"""Column expressions: cast-all, key columns, partition columns, ordering.

All built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's (key cleaning and rule keys).
KEY_STRIP_PATTERN = "[-:.,/ ]"
KEY_RULES = ("row_key", "f_key")
PART_RULES = ("part_1", "part_2", "part_3")


def cast_all(df: DataFrame, dtype: str = "string") -> DataFrame:
    """Every column to ``dtype``; a null stays null. One projection."""
    return df.select(*[F.col(c).cast(dtype).alias(c) for c in df.columns])


def clean_key(cols: Sequence[str]) -> Column:
    """Join the columns with '' (nulls skipped, all-null gives '')
    and delete ``- : . , /`` and space."""
    return F.regexp_replace(F.concat_ws("", *[F.col(c) for c in cols]), KEY_STRIP_PATTERN, "")


def prefix3(c: str) -> Column:
    """First three characters; an empty text gives null, as a
    partitioned write stores both in the null partition."""
    return F.nullif(F.substring(F.col(c), 1, 3), F.lit(""))


def as_date(c: str | Column) -> Column:
    """Date of a string/timestamp; bad text gives null (ANSI-safe)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("date")


def position_order(c: str, lexicographic: bool = False) -> list[Column]:
    """Sort keys (descending) for a trail position held as text.

    Default orders numerically ("10" after "9"), non-numeric text last;
    ``lexicographic=True`` keeps plain string order.
    """
    if lexicographic:
        return [F.col(c).desc_nulls_last()]
    return [F.col(c).try_cast("decimal(38,0)").desc_nulls_last(), F.col(c).desc_nulls_last()]


@dataclass(frozen=True)
class ColumnRule:
    """One ``additional_columns`` entry: rule key, output name, formula."""

    columnkey: str | None
    columnname: str | None
    columnformula: str | None


def active_rules(rules: Iterable[ColumnRule]) -> list[ColumnRule]:
    """J10f: rules with a null key or name are skipped; unknown keys ignored."""
    known = set(KEY_RULES) | set(PART_RULES)
    return [r for r in rules if r.columnkey is not None and r.columnname is not None and r.columnkey in known]


def rule_column(rule: ColumnRule, date_partitioned: bool = False) -> Column:
    """The expression of one rule (J10a-e)."""
    key, formula = rule.columnkey, rule.columnformula or ""
    if key in KEY_RULES:
        return clean_key([c.strip() for c in formula.split(",")])
    if key == "part_1":
        return F.year(as_date(formula)) if date_partitioned else prefix3(formula)
    if key == "part_2":
        return F.month(as_date(formula))
    if key == "part_3":
        return as_date(formula)
    raise ValueError(f"unknown rule key {key!r}")


def derive_columns(df: DataFrame, rules: Iterable[ColumnRule], date_partitioned: bool = False) -> DataFrame:
    """Apply the rules in order. A later rule may use a column an
    earlier rule derived, so rules fold one ``withColumn`` at a time
    (Catalyst collapses the projections)."""
    for r in active_rules(rules):
        df = df.withColumn(r.columnname, rule_column(r, date_partitioned))
    return df


def partition_types(rules: Iterable[ColumnRule], date_partitioned: bool = False) -> dict[str, str]:
    """Spark SQL type of each partition column the rules make."""
    types = {"part_1": "int" if date_partitioned else "string", "part_2": "int", "part_3": "date"}
    return {r.columnname: types[r.columnkey] for r in active_rules(rules) if r.columnkey in PART_RULES}


def partition_columns(rules: Iterable[ColumnRule]) -> list[str]:
    """Names of the partition columns in part_1, part_2, part_3 order."""
    by_key = {r.columnkey: r.columnname for r in active_rules(rules) if r.columnkey in PART_RULES}
    return [by_key[k] for k in PART_RULES if k in by_key]
