"""Changesets from edits, and changeset labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import DEFAULT_EDITORS, editor_label, has_project_tag, last_project_tag

KINDS = ("node", "way", "rel")


def _summary(edits: DataFrame, with_box: bool) -> DataFrame:
    aggs = [
        F.min("uid").alias("uid"),
        F.min("timestamp").alias("first_date"),
        F.max("timestamp").alias("last_date"),
    ]
    if with_box:
        aggs += [
            F.min("latitude").alias("min_lat"), F.max("latitude").alias("max_lat"),
            F.min("longitude").alias("min_lon"), F.max("longitude").alias("max_lon"),
        ]
    aggs.append(F.count(F.lit(1)).cast("int").alias("num_edits"))
    return edits.groupBy("changeset").agg(*aggs)


def summary_node(node_edits: DataFrame) -> DataFrame:
    """A1: node edits per changeset with their box."""
    return _summary(node_edits, True)


def summary_way(way_edits: DataFrame) -> DataFrame:
    """A2: way edits per changeset."""
    return _summary(way_edits, False)


def summary_rel(rel_edits: DataFrame) -> DataFrame:
    """A3: relation edits per changeset."""
    return _summary(rel_edits, False)


def rollup(node_edits: DataFrame, way_edits: DataFrame, rel_edits: DataFrame) -> DataFrame:
    """A4 + J3: one row per changeset over all three edit tables.

    The reference aggregates each table and full-outer-joins the three results.
    Here the three scans are tagged with their kind and unioned, and a single
    conditional aggregation runs on top: one shuffle on ``changeset`` with
    map-side partial aggregation, no join. uid prefers the node side, then way,
    then relation (COALESCE of the per-kind minimums).
    """
    def tagged(df: DataFrame, kind: str) -> DataFrame:
        lat = F.col("latitude") if kind == "node" else F.lit(None).cast("double")
        lon = F.col("longitude") if kind == "node" else F.lit(None).cast("double")
        return df.select(
            F.lit(kind).alias("kind"), "changeset", "uid", "timestamp", lat.alias("latitude"), lon.alias("longitude")
        )

    edits = tagged(node_edits, "node").unionByName(tagged(way_edits, "way")).unionByName(tagged(rel_edits, "rel"))
    kind = F.col("kind")
    counts = {k: F.count_if(kind == F.lit(k)).cast("int") for k in KINDS}
    out = edits.groupBy("changeset").agg(
        F.coalesce(*[F.min(F.when(kind == F.lit(k), F.col("uid"))) for k in KINDS]).alias("uid"),
        F.min("timestamp").alias("first_date"),
        F.max("timestamp").alias("last_date"),
        F.min("latitude").alias("min_lat"), F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"), F.max("longitude").alias("max_lon"),
        counts["node"].alias("node_edits"),
        counts["way"].alias("way_edits"),
        counts["rel"].alias("rel_edits"),
    )
    return out.withColumn("num_edits", F.col("node_edits") + F.col("way_edits") + F.col("rel_edits"))


def with_bbox(changeset: DataFrame) -> DataFrame:
    """G1: the changeset box as WKT (NULL without coordinates)."""
    return changeset.select("changeset", geo.bbox_wkt("min_lat", "max_lat", "min_lon", "max_lon").alias("bbox"))


def with_area(changeset: DataFrame) -> DataFrame:
    """Box area in m2 on the ellipsoid."""
    return changeset.select("changeset", geo.bbox_area_m2("min_lat", "max_lat", "min_lon", "max_lon").alias("area_m2"))


def small_area(changeset: DataFrame, max_m2: float = geo.MAX_BOX_AREA_M2) -> DataFrame:
    """P6 + P7: changesets with coordinates and a box of at most ``max_m2``."""
    return changeset.where(geo.box_is_small("min_lat", "max_lat", "min_lon", "max_lon", max_m2)).select("changeset")


def way_id_list(way_edits: DataFrame) -> DataFrame:
    """S8 + A12: distinct way ids."""
    return way_edits.select("id").distinct()


def project_tags(description: DataFrame) -> DataFrame:
    """The (last) project tag of each project's changeset comment template."""
    return description.where(has_project_tag("changeset_comment")).select(
        "hot_project", last_project_tag("changeset_comment").alias("hot_tag")
    )


def editors(changeset: DataFrame, tags: DataFrame, editor_names=DEFAULT_EDITORS) -> DataFrame:
    """P3 + J9: every changeset with its editor; no created_by tag gives 'Other' and NULL.

    The tag filter sits in the ON clause of the reference's left join, so it is
    applied to the tag side before joining. Two created_by tags give two rows.
    """
    created_by = tags.where(F.col("key") == F.lit("created_by")).select("changeset", F.col("value").alias("editor_full"))
    return changeset.select("changeset").join(created_by, "changeset", "left").select(
        "changeset", editor_label("editor_full", editor_names).alias("editor"), "editor_full"
    )


def comments(tags: DataFrame) -> DataFrame:
    """Non-empty comment tags."""
    return tags.where(
        (F.col("key") == F.lit("comment")) & F.col("value").isNotNull() & (F.col("value") != F.lit(""))
    ).select("changeset", F.col("value").alias("comment"))
