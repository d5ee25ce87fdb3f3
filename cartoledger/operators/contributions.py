"""Per-user first contribution, prior experience and totals.

A user's "day" is a 24-hour slot in the user's own phase: the time of day of
the first contribution (``tz_offset``) is subtracted before taking the date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import hours, time_of_day
from .joins import bounded_broadcast

# Fixed value of the reference: start_of_day lies 12 hours before the first contribution.
DEFAULT_DAY_OFFSET_HOURS = 12


def first_contribution(session: DataFrame, day_offset_hours: int = DEFAULT_DAY_OFFSET_HOURS) -> DataFrame:
    """Each user's first session; ties on the start go to the lower project, then session.

    ``min_by`` with partial aggregation: a user with very many sessions costs one
    row per task before the shuffle.
    """
    first = session.groupBy("uid").agg(
        F.min_by(F.struct("hot_project", "first_date"), F.struct("first_date", "hot_project", "session")).alias("_f")
    )
    d = F.col("_f.first_date")
    return first.select(
        "uid",
        F.col("_f.hot_project").alias("hot_project"),
        d.alias("date"),
        (d - hours(day_offset_hours)).alias("start_of_day"),
        time_of_day(d).alias("tz_offset"),
    )


def _phase_day(ts: str) -> F.Column:
    return F.to_date(F.col(ts) - F.col("tz_offset"))


def prior_experience(first: DataFrame, changeset: DataFrame) -> DataFrame:
    """A7 + J14: distinct phase days with any changeset that ended before the user's start_of_day.

    All the user's changesets count, assigned or not. Users without such a
    changeset get 0. The user table (one row per contributor) is broadcast
    behind a measured bound; ``count_distinct`` deduplicates (uid, day) before
    the shuffle on uid, so a prolific user does not hold up one task.
    """
    users = first.select("uid", "start_of_day", "tz_offset")
    days = (
        changeset.select("uid", "first_date", "last_date")
        .join(bounded_broadcast(users), "uid")
        .where(F.col("last_date") < F.col("start_of_day"))
        .groupBy("uid")
        .agg(F.count_distinct(_phase_day("first_date")).alias("num_days_with_edits"))
    )
    return first.select("uid").join(days, "uid", "left").select(
        "uid", F.coalesce("num_days_with_edits", F.lit(0)).cast("long").alias("num_days_with_edits")
    )


def totals(first: DataFrame, session: DataFrame) -> DataFrame:
    """A8 + J15: per user span, distinct phase days, distinct projects, labour hours and edits."""
    users = first.select("uid", "tz_offset")
    return (
        session.join(bounded_broadcast(users), "uid")
        .groupBy("uid")
        .agg(
            F.min("first_date").alias("first_date"),
            F.max("last_date").alias("last_date"),
            F.count_distinct(_phase_day("first_date")).alias("num_days_with_edits"),
            F.count_distinct("hot_project").alias("num_projects"),
            F.sum("labour_hours").alias("labour_hours"),
            F.sum("num_edits").cast("long").alias("num_edits"),
        )
    )
