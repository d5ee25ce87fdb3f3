"""Data checks (C1-C7): constraints of the reference re-aimed as jobs that return offending rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import not_null_columns


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > F.lit(1))


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a NULL in any of ``columns``."""
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.where(cond)


def null_violations_of(df: DataFrame, table: str) -> DataFrame:
    """C7 driven by the declared schema."""
    return null_violations(df, not_null_columns(table))


def null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """C7 as a report: per declared table its rows and how many break a NOT NULL."""
    parts = []
    for name, df in tables.items():
        bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in not_null_columns(name)])
        parts.append(
            df.agg(F.count(F.lit(1)).alias("num_rows"), F.count_if(bad).alias("num_violations")).select(
                F.lit(name).alias("table_name"), "num_rows", "num_violations"
            )
        )
    return reduce(DataFrame.unionByName, parts)
