"""Mapping of the driver's synthetic tables onto the pipeline's input tables.

The test data are TPC-H-like tables plus an ``events`` stream; none of them is a
map-edit history. This module derives the pipeline's inputs from them with pure
column expressions, so every query reads the given tables and its work grows
with them. The same mapping is written in DuckDB SQL in ``plans/oracle.py``.

Mapping (fixed rules of the test fixture):

* edits: one edit per event. ``id = event_id % 400``,
  ``version = event_id div 400 + 1``, ``uid = user_id``, ``timestamp = ts``,
  ``visible = event_id % 10 <> 0``, ``changeset = user_id * 10000 +
  (day(ts) - 1) * 12 + hour(ts) div 2`` (one changeset per user and two-hour slot).
  view/click/purchase are node edits, signup way edits, error relation edits.
  Node coordinates: ``p = user_id % 25``, ``lat = p*4 - 48 + ((event_id*37) % 20)/100 - 0.1``,
  ``lon = p*10 - 120 + ((event_id*53) % 20)/100 - 0.1``.
* uid_username: customers whose key is not a multiple of 11.
* registered contributor names: customer at project ``c_custkey % 25`` with
  ``num_tasks = c_custkey % 9 + 1``, unless the key is a multiple of 7.
* history contributors: every customer at project ``(c_custkey + 1) % 25``
  (each row twice), plus project ``c_custkey % 25`` for keys that are multiples of 5.
* projects: one per nation. Private if ``n % 10 = 3``, draft if ``n % 10 = 7``,
  archived if ``n`` is odd; comment NULL if ``n % 5 = 4``.
  Activity from 2024-01-01 + 6n hours to 2024-01-20 + 6n hours.
  Region: two triangles, at homes ``n`` and ``(n + 24) % 25``.
* changeset tags: ``created_by`` unless ``changeset % 7 = 0``; ``comment`` always
  ('' if ``changeset % 6 = 0``, NULL if ``changeset % 6 = 1``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeops import hours, ntz

# ---------------------------------------------------------------------------
# Fixed values of the test fixture
NODE_EVENT_TYPES = ("view", "click", "purchase")
WAY_EVENT_TYPES = ("signup",)
REL_EVENT_TYPES = ("error",)
ID_SPACE = 400
# Editor tag value by changeset % 5; the last one stands for a missing value.
EDITOR_VALUES = ("JOSM/1.5 (9329 en)", "iD 2.20.2", "Potlatch 2.3", "other editor", None)
# Triangle corners relative to a home point (lon, lat).
TRIANGLE = ((-0.2, -0.2), (0.2, -0.2), (0.0, 0.05))
NUM_PROJECTS = 25
# ---------------------------------------------------------------------------

KIND_EVENTS = {"node": NODE_EVENT_TYPES, "way": WAY_EVENT_TYPES, "rel": REL_EVENT_TYPES}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _changeset_of(user_id: Column, ts: Column) -> Column:
    slot = F.floor(F.hour(ts) / F.lit(2))
    return (user_id * F.lit(10000) + (F.dayofmonth(ts) - F.lit(1)) * F.lit(12) + slot).cast("int")


def _edit_columns(ev: DataFrame) -> list[Column]:
    return [
        (F.col("event_id") % F.lit(ID_SPACE)).alias("id"),
        (F.floor(F.col("event_id") / F.lit(ID_SPACE)) + F.lit(1)).cast("int").alias("version"),
        _changeset_of(F.col("user_id"), F.col("ts")).alias("changeset"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.col("user_id").cast("int").alias("uid"),
    ]


def _coords() -> list[Column]:
    p = F.col("user_id") % F.lit(NUM_PROJECTS)
    eid = F.col("event_id")
    lat = (p * F.lit(4) - F.lit(48)).cast("double") + ((eid * F.lit(37)) % F.lit(20)).cast("double") / F.lit(100.0) - F.lit(0.1)
    lon = (p * F.lit(10) - F.lit(120)).cast("double") + ((eid * F.lit(53)) % F.lit(20)).cast("double") / F.lit(100.0) - F.lit(0.1)
    return [lat.alias("latitude"), lon.alias("longitude")]


def edits(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """node_edits / way_edits / rel_edits."""
    ev = _read(spark, sf_dir, "events").where(F.col("event_type").isin(*KIND_EVENTS[kind]))
    cols = _edit_columns(ev)
    if kind == "node":
        cols += _coords()
    cols.append((F.col("event_id") % F.lit(10) != F.lit(0)).alias("visible"))
    return ev.select(*cols)


def node_edits(spark, sf_dir):
    return edits(spark, sf_dir, "node")


def way_edits(spark, sf_dir):
    return edits(spark, sf_dir, "way")


def rel_edits(spark, sf_dir):
    return edits(spark, sf_dir, "rel")


def _kind_of(event_type: Column) -> Column:
    return (
        F.when(event_type.isin(*NODE_EVENT_TYPES), F.lit("node"))
        .when(event_type.isin(*WAY_EVENT_TYPES), F.lit("way"))
        .when(event_type.isin(*REL_EVENT_TYPES), F.lit("rel"))
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full version history of all users, as the history dump would give it.

    Columns: kind, id, version, changeset, timestamp, uid, username, latitude,
    longitude (NULL unless a node), visible. The username changes on the 16th of
    the month, so a uid has had two names.
    """
    ev = _read(spark, sf_dir, "events")
    is_node = F.col("event_type").isin(*NODE_EVENT_TYPES)
    lat, lon = _coords()
    renamed = F.when(F.dayofmonth("ts") > F.lit(15), F.lit("_renamed")).otherwise(F.lit(""))
    return ev.select(
        _kind_of(F.col("event_type")).alias("kind"),
        *_edit_columns(ev),
        F.concat(F.lit("mapper_"), F.col("user_id").cast("string"), renamed).alias("username"),
        F.when(is_node, lat).alias("latitude"),
        F.when(is_node, lon).alias("longitude"),
        (F.col("event_id") % F.lit(10) != F.lit(0)).alias("visible"),
    )


def tag_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag rows of every version: the keys and values of ``events.props``."""
    ev = _read(spark, sf_dir, "events")
    tags = F.from_json(F.col("props"), "map<string,string>")
    return ev.select(
        _kind_of(F.col("event_type")).alias("kind"), *_edit_columns(ev), F.explode(tags).alias("key", "value")
    )


def uid_username(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.where(F.col("c_custkey") % F.lit(11) != F.lit(0)).select(
        F.col("c_custkey").cast("int").alias("uid"), F.col("c_name").alias("username")
    )


def registered_contributor_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.where(F.col("c_custkey") % F.lit(7) != F.lit(0)).select(
        (F.col("c_custkey") % F.lit(NUM_PROJECTS)).cast("int").alias("hot_project"),
        F.col("c_name").alias("username"),
        (F.col("c_custkey") % F.lit(9) + F.lit(1)).cast("int").alias("num_tasks"),
    )


def _history_contributor_rows(c: DataFrame, project: Column) -> DataFrame:
    return c.select(
        F.concat(F.lit("#hotosm-project-"), project.cast("string")).alias("hot_tag"),
        project.cast("int").alias("hot_project"),
        F.col("c_custkey").cast("int").alias("uid"),
        F.col("c_name").alias("username"),
    )


def history_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    shifted = _history_contributor_rows(c, (F.col("c_custkey") + F.lit(1)) % F.lit(NUM_PROJECTS))
    home = _history_contributor_rows(
        c.where(F.col("c_custkey") % F.lit(5) == F.lit(0)), F.col("c_custkey") % F.lit(NUM_PROJECTS)
    )
    return shifted.unionByName(shifted).unionByName(home)


def project_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    comment = F.when(k % F.lit(5) == F.lit(4), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("Mapping #hotosm-old-1 for #hotosm-project-"), k.cast("string"), F.lit(" today"))
    )
    return n.select(
        k.cast("int").alias("hot_project"),
        F.col("n_name").alias("title"),
        (k % F.lit(10) == F.lit(3)).alias("is_private"),
        (k % F.lit(2) == F.lit(1)).alias("is_archived"),
        (k % F.lit(10) == F.lit(7)).alias("is_draft"),
        comment.alias("changeset_comment"),
    )


def project_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    shift = hours(F.col("n_nationkey").cast("int") * F.lit(6))
    return n.select(
        F.col("n_nationkey").cast("int").alias("hot_project"),
        (ntz("2024-01-01 00:00:00") + shift).alias("first_date"),
        (ntz("2024-01-20 00:00:00") + shift).alias("last_date"),
        F.lit(None).cast("double").alias("perc_done"),
        F.lit(None).cast("double").alias("perc_validated"),
    )


def _triangle(home: Column) -> Column:
    lon = (home * F.lit(10) - F.lit(120)).cast("double")
    lat = (home * F.lit(4) - F.lit(48)).cast("double")
    pts = [F.array(lon + F.lit(dx), lat + F.lit(dy)) for dx, dy in TRIANGLE]
    return F.array(F.array(*pts, pts[0]))


def project_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One multi-polygon per project: two triangles (GeoJSON coordinate nesting)."""
    n = _read(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select(
        k.cast("int").alias("hot_project"),
        F.array(_triangle(k), _triangle((k + F.lit(NUM_PROJECTS - 1)) % F.lit(NUM_PROJECTS))).alias("geom"),
    )


def _changesets_of_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    return ev.groupBy(_changeset_of(F.col("user_id"), F.col("ts")).alias("changeset")).agg(
        F.min("ts").cast("timestamp_ntz").alias("created_at"),
        F.max("ts").cast("timestamp_ntz").alias("closed_at"),
        F.min("user_id").cast("int").alias("uid"),
        F.count(F.lit(1)).cast("int").alias("num_changes"),
    )


def changeset_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    cs = _changesets_of_edits(spark, sf_dir)
    return cs.select(
        "changeset", "created_at", "closed_at", "uid",
        F.concat(F.lit("mapper_"), F.col("uid").cast("string")).alias("username"),
        "num_changes",
        F.lit(0).alias("comments_count"),
    )


def _editor_value(cs: Column) -> Column:
    expr = None
    for i, v in enumerate(EDITOR_VALUES):
        lit = F.lit(v).cast("string")
        expr = F.when(cs % F.lit(5) == F.lit(i), lit) if expr is None else expr.when(cs % F.lit(5) == F.lit(i), lit)
    return expr


def _comment_value(cs: Column) -> Column:
    text = F.concat(
        F.lit("Mapping #hotosm-project-"), (cs % F.lit(NUM_PROJECTS)).cast("string"),
        F.lit(" and #hotosm-project-"), ((cs + F.lit(7)) % F.lit(NUM_PROJECTS)).cast("string"),
        F.lit(" #missingmaps"),
    )
    return (
        F.when(cs % F.lit(6) == F.lit(0), F.lit(""))
        .when(cs % F.lit(6) == F.lit(1), F.lit(None).cast("string"))
        .otherwise(text)
    )


def changeset_meta_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    cs = F.col("changeset")
    ids = _changesets_of_edits(spark, sf_dir).select("changeset")
    created = ids.where(cs % F.lit(7) != F.lit(0)).select(cs, F.lit("created_by").alias("key"), _editor_value(cs).alias("value"))
    comment = ids.select(cs, F.lit("comment").alias("key"), _comment_value(cs).alias("value"))
    return created.unionByName(comment)
