"""History filters (H1-H4): semi-joins of a large version history with id lists.

``history`` has one row per object version: kind ('node', 'way', 'rel'), id,
version, changeset, timestamp, uid, username, latitude, longitude, visible.
``tag_history`` has one row per (version, tag): kind, id, version, changeset,
timestamp, uid, key, value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import bounded_broadcast

_HEAD = ["id", "version", "changeset", "timestamp", "uid"]


def uid_username(history: DataFrame) -> DataFrame:
    """H1: one name per uid, the one on the latest version the user saved.

    Which name wins is not written down in the reference (the program that made
    the map lives elsewhere); the latest one is the name the account has today.
    Partial aggregation keeps a hot uid cheap: each task sends one row per uid.
    """
    return (
        history.where(F.col("uid").isNotNull())
        .groupBy("uid")
        .agg(F.max_by("username", F.struct("timestamp", "version", "id")).alias("username"))
    )


def user_edits(history: DataFrame, uids: DataFrame, kind: str) -> DataFrame:
    """H2: versions saved by the listed users, for one object kind."""
    cols = _HEAD + (["latitude", "longitude"] if kind == "node" else []) + ["visible"]
    ids = bounded_broadcast(uids.select("uid").distinct())
    return history.where(F.col("kind") == F.lit(kind)).join(ids, "uid", "left_semi").select(*cols)


def user_tag_edits(tag_history: DataFrame, uids: DataFrame, kind: str) -> DataFrame:
    """H3: tag rows of versions saved by the listed users, for one object kind.

    Every tag of every such version is kept (not only changed ones); whether the
    external program emitted only changes is not settled by the reference.
    """
    ids = bounded_broadcast(uids.select("uid").distinct())
    return (
        tag_history.where(F.col("kind") == F.lit(kind))
        .join(ids, "uid", "left_semi")
        .select(*_HEAD, "key", "value")
    )


def way_deletions(history: DataFrame, way_ids: DataFrame) -> DataFrame:
    """H4: deleted versions of the listed ways, whoever deleted them.

    The id list grows with the edit tables, so it is broadcast only when its
    measured size allows; otherwise both sides shuffle on ``id``.
    """
    ids = bounded_broadcast(way_ids.select("id").distinct())
    return (
        history.where((F.col("kind") == F.lit("way")) & ~F.col("visible"))
        .join(ids, "id", "left_semi")
        .select(*_HEAD)
    )
