"""Reports (A9, A10, A13, O1, P9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import bounded_broadcast

# Fixed values of the reference report.
TOP_PROJECTS = 100
TITLE_CHARS = 50


def monthly(assigned: DataFrame) -> DataFrame:
    """A10: per month of last_date, distinct projects and users and summed edits.

    A changeset in two projects counts once per project, as in the reference.
    """
    return assigned.groupBy(F.date_format(F.to_date("last_date"), "yyyy-MM").alias("month")).agg(
        F.count_distinct("hot_project").alias("num_projects"),
        F.count_distinct("uid").alias("num_users"),
        F.sum("num_edits").cast("long").alias("num_edits"),
    )


def _flag(c: str):
    return F.when(F.col(c), F.lit("t")).otherwise(F.lit(""))


def top_projects(assigned: DataFrame, description: DataFrame, n: int = TOP_PROJECTS) -> DataFrame:
    """A9 + J16 + O1 + P9: most active projects by distinct users (ties: lower project first).

    Grouped by the full title (the 50-character form is only the output).
    ``orderBy(..).limit(n)`` plans as a TakeOrderedAndProject: each task keeps
    its own top n, so no global sort.
    """
    d = bounded_broadcast(description.select("hot_project", "title", "is_private", "is_archived", "is_draft"))
    agg = assigned.join(d, "hot_project").groupBy("hot_project", "title", "is_private", "is_archived", "is_draft").agg(
        F.count_distinct("uid").alias("num_users"),
        F.sum("num_edits").cast("long").alias("num_edits"),
        F.count(F.lit(1)).alias("num_changesets"),
    )
    return (
        agg.select(
            "hot_project", F.substring("title", 1, TITLE_CHARS).alias("title"), "num_users", "num_edits",
            "num_changesets", _flag("is_private").alias("priv"), _flag("is_archived").alias("arch"),
            _flag("is_draft").alias("draft"),
        )
        .orderBy(F.desc("num_users"), F.asc("hot_project"))
        .limit(n)
    )


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """A13 re-aimed: rows per pipeline table, most rows first (the reference lists on-disk size per table)."""
    parts = [df.agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(name).alias("table_name"), "num_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("num_rows"), "table_name")
