"""Project contributors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import all_project_tags, tag_project_id


def tagged_contributors(meta: DataFrame, tags: DataFrame) -> DataFrame:
    """(hot_tag, hot_project, uid, username) of every changeset whose comment carries a project tag.

    Rule inferred (the parser lives outside the reference): every project tag in
    the comment counts; the project is the number after the tag's last '-'.
    Free text can hold any digits: a number too long for a project id names no
    project, and the tag is passed over.
    """
    comments = tags.where((F.col("key") == F.lit("comment")) & F.col("value").isNotNull())
    hits = comments.select("changeset", F.explode(all_project_tags("value")).alias("hot_tag"))
    return (
        hits.join(meta.select("changeset", "uid", "username"), "changeset")
        .select("hot_tag", tag_project_id("hot_tag").alias("hot_project"), "uid", "username")
        .where(F.col("hot_project").isNotNull())
        .distinct()
    )


def registered(names: DataFrame, uid_username: DataFrame) -> DataFrame:
    """Registered names with their uid; a name not found keeps a NULL uid."""
    return names.join(uid_username, "username", "left").select("hot_project", "uid", "username", "num_tasks")


def combined(registered_df: DataFrame, history_contributor: DataFrame) -> DataFrame:
    """J2 + P4 + A11: registered contributors with a uid, or tagged ones, one row per distinct tuple.

    The reference full-outer-joins on (hot_project, uid), takes the registered
    side's values first and groups by the four coalesced columns. Same result,
    one wide shuffle: tag both sides, deduplicate map-side, and keep the
    registered rows of a pair when it has any.
    """
    reg = registered_df.where(F.col("uid").isNotNull()).select(
        "hot_project", "uid", "username", F.lit(True).alias("has_submitted_tasks")
    )
    hist = history_contributor.select("hot_project", "uid", "username", F.lit(False).alias("has_submitted_tasks"))
    rows = reg.unionByName(hist).groupBy("hot_project", "uid", "username").agg(
        F.max("has_submitted_tasks").alias("has_submitted_tasks")
    )
    pair_registered = F.max("has_submitted_tasks").over(Window.partitionBy("hot_project", "uid"))
    return (
        rows.withColumn("_reg", pair_registered)
        .where(F.col("has_submitted_tasks") == F.col("_reg"))
        .select("hot_project", "uid", "username", "has_submitted_tasks")
    )


def uid_list(contributor: DataFrame) -> DataFrame:
    """S7 + A12: distinct known uids."""
    return contributor.where(F.col("uid").isNotNull()).select("uid").distinct()


def match_rate(registered_df: DataFrame) -> DataFrame:
    """Registered usernames with and without a uid."""
    return registered_df.groupBy(F.col("uid").isNull().alias("unmatched")).agg(
        F.count_distinct("username").alias("num_users")
    )
