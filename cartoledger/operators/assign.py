"""Changeset-to-project assignment.

A changeset belongs to a project when its author contributes to the project,
it overlaps the project's activity period, the project is visible, its box has
coordinates and is at most 100 km2, and the box meets the project region.

Plan: the project level (activity x visible description x valid region within
the world) is built once per run by ``project_areas``, one row per project, and
its regions are indexed by cell (``regioncells``). Joined to the contributors
the project level gives the project side, keyed by uid and small; it is
broadcast behind a measured bound, so the large changeset table streams through
a hash join without being shuffled. The time test and a cheap region-extent
test ride on that join as a residual. What is left meets the index by an
equi-join on (project, level, cell), and only the edges of that block are
tested. Beyond the bounds both joins shuffle: on uid with the rows of heavy
users dealt to several tasks, and on the cell, which spreads a large project.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import stage
from . import regioncells
from .joins import bounded_broadcast, bounded_broadcast_by, fits_broadcast, spread

# Edges of a cell that are compared with each other at once; a cell with more is split, down to MAX_SPLIT halvings.
CELL_EDGES = 64
SPLIT = 3
MAX_SPLIT = 18


def region_edges(region: DataFrame) -> DataFrame:
    """Regions with their edge list, extent and index depth: hot_project, edges, rx0, ry0, rx1, ry1, depth."""
    x0, y0, x1, y1 = geo.region_extent("geom")
    return region.select(
        "hot_project",
        geo.region_edges("geom").alias("edges"),
        x0.alias("rx0"), y0.alias("ry0"), x1.alias("rx1"), y1.alias("ry1"),
    ).select("*", regioncells.depth(F.col("edges")).alias("depth"))


def _features(region: DataFrame) -> DataFrame:
    """Regions with ``_f``, a key of the feature: a project may have several rows, each valid or not on its own."""
    return region.select("hot_project", "geom", F.xxhash64(F.to_json("geom")).alias("_f"))


def _leaf_cells(features: DataFrame) -> DataFrame:
    """Edges ``(_f, level, cx, cy, eid, e)`` by cells: any two edges that meet share one.

    A feature of few edges is one cell. Larger ones are split into cells along
    the lines of their edges, and cells that still hold many edges are split
    again, so cells follow the density of the edges and a long edge is written
    out only where others crowd round it.
    """
    x0, y0, x1, y1 = geo.region_extent("geom")
    edges = features.select(
        "_f", geo.region_edges("geom").alias("edges"),
        x0.alias("rx0"), y0.alias("ry0"), x1.alias("rx1"), y1.alias("ry1"),
    ).select(
        "_f", "rx0", "ry0", "rx1", "ry1", F.size("edges").alias("_n"), F.lit(0).alias("level"),
        F.lit(0).alias("cx"), F.lit(0).alias("cy"), F.posexplode("edges").alias("eid", "e"),
    )
    columns = ["_f", "level", "cx", "cy", "eid", "e"]
    leaves = edges.where(F.col("_n") <= CELL_EDGES).select(columns)
    crowded = edges.where(F.col("_n") > CELL_EDGES).drop("_n")
    if not crowded.head(1):
        return leaves
    level = 0
    while True:
        level += SPLIT
        own = crowded.withColumnsRenamed({"cx": "_px", "cy": "_py"}).withColumn("level", F.lit(level))
        first = [F.shiftleft(c, SPLIT) for c in ("_px", "_py")]
        within = [first[0], first[0] + (1 << SPLIT) - 1, first[1], first[1] + (1 << SPLIT) - 1]
        cells = stage(regioncells.cross_cells(own, 1, within).drop("_px", "_py"), f"edge_cells_{level}")
        full = cells.groupBy("_f", "cx", "cy").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL_EDGES)
        if level >= MAX_SPLIT or not full.head(1):
            return leaves.unionByName(cells.select(columns))
        leaves = leaves.unionByName(cells.join(full, ["_f", "cx", "cy"], "left_anti").select(columns))
        crowded = cells.join(full, ["_f", "cx", "cy"], "left_semi").select(cells.columns)


def _meeting_points(a: Column, b: Column) -> Column:
    """Where two rings of one polygon touch, from an edge of each: ``array<struct<part,ring,x,y>>``, a row per ring and point."""

    def at(e: Column, x: Column, y: Column) -> Column:
        return F.when(geo.on_segment(e, x, y), F.struct(x.alias("x"), y.alias("y")))

    points = F.array(at(b, a.x1, a.y1), at(b, a.x2, a.y2), at(a, b.x1, b.y1), at(a, b.x2, b.y2))
    points = F.array_distinct(F.filter(points, lambda p: p.isNotNull()))
    return F.flatten(
        F.transform(
            points,
            lambda p: F.array(
                *[F.struct(e.part.alias("part"), e.ring.alias("ring"), p.x.alias("x"), p.y.alias("y")) for e in (a, b)]
            ),
        )
    )


def _cut_apart(touches: DataFrame) -> DataFrame:
    """``_f`` of the features with a polygon whose rings cut its interior in pieces.

    Rings and the points where they touch make a graph (``touches``: a row per
    ring and point). The interior is in one piece exactly if the graph has no
    cycle: ends are taken off until none is left, and what stays is on a cycle
    or between two.
    """
    polygon, ring, point = ["_f", "part"], ["_f", "part", "ring"], ["_f", "part", "x", "y"]
    left = stage(touches.distinct(), "ring_touches")
    n = left.count()
    while n:
        for node in (ring, point):
            inner = left.groupBy(*node).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
            left = left.join(inner, node, "left_semi")
        left = stage(left.select(*polygon, "ring", "x", "y"), "ring_touches")
        before, n = n, left.count()
        if n == before:
            break
    return left.select("_f").distinct()


def _conflicting(features: DataFrame) -> DataFrame:
    """``_f`` of the features with two edges that no valid region has, or with an interior in pieces.

    Only edges that share a cell are compared (``geo.edges_conflict``): an
    equi-join on (feature, cell), not a comparison of every pair in a region.
    """
    cells = _leaf_cells(features)
    a, b = cells.alias("a"), cells.alias("b")
    x, y = F.col("a.e"), F.col("b.e")
    conflict = geo.edges_conflict(x, y)
    touch = (x.part == y.part) & (x.ring != y.ring) & geo.segments_touch(x, y)
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("_f", "level", "cx", "cy")]
    pairs = a.join(b, same[0] & same[1] & same[2] & same[3] & (F.col("a.eid") < F.col("b.eid")) & (conflict | touch))
    points = F.when(~conflict, _meeting_points(x, y))
    found = pairs.select(F.col("a._f").alias("_f"), conflict.alias("bad"), points.alias("points"))
    found = stage(
        found.groupBy("_f").agg(F.max("bad").alias("bad"), F.array_distinct(F.flatten(F.collect_list("points"))).alias("points")),
        "edge_conflicts",
    )
    bad = found.where("bad").select("_f")
    touches = found.where("not bad").select("_f", F.explode("points").alias("p")).select("_f", "p.*")
    return bad.union(_cut_apart(touches)) if touches.head(1) else bad


def _shape_ok():
    """Row tests of G4: closed rings, and only then how they nest."""
    return F.when(geo.rings_closed("geom"), geo.nesting_ok("geom")).otherwise(F.lit(False))


def region_valid(region: DataFrame) -> DataFrame:
    """``ST_IsValid`` per feature: closed rings of 4+ points that neither cross, overlap nor touch
    themselves, holes inside their shell, polygons outside each other, interiors in one piece."""
    features = _features(region)
    bad = _conflicting(features).withColumn("_bad", F.lit(True))
    return features.join(bad, "_f", "left").select(
        "hot_project", (_shape_ok() & F.col("_bad").isNull()).alias("is_valid")
    )


def region_in_world(region: DataFrame) -> DataFrame:
    """G3 + G5: the region lies within the world box."""
    return region.select("hot_project", geo.within_world("geom").alias("in_world"))


def usable_regions(region: DataFrame) -> DataFrame:
    """Regions that are valid (G4) and within the world (G5), with edges and extent, one row per project.

    Each feature is tested on its own; the usable features of a project then
    make up its region. Row tests come first, the edge test removes features
    by an anti-join.
    """
    ok = _features(region).where(_shape_ok() & geo.within_world("geom"))
    ok = ok.join(_conflicting(ok), "_f", "left_anti")
    return region_edges(ok.groupBy("hot_project").agg(F.flatten(F.collect_list("geom")).alias("geom")))


def _boxes(changeset: DataFrame) -> DataFrame:
    return changeset.where(F.col("min_lat").isNotNull()).select(
        "changeset", "uid", "first_date", "last_date", "min_lat", "max_lat", "min_lon", "max_lon"
    )


def _overlaps_period(c_first, c_last, a_first, a_last):
    """Closed intervals overlap."""
    return (a_first <= c_last) & (a_last >= c_first)


def _box_meets_extent():
    return (
        (F.col("min_lon") <= F.col("rx1")) & (F.col("max_lon") >= F.col("rx0"))
        & (F.col("min_lat") <= F.col("ry1")) & (F.col("max_lat") >= F.col("ry0"))
    )


def _by_cells(cand: DataFrame, cells: DataFrame, cells_total: int | None = None) -> DataFrame:
    """Rows of ``cand`` (boxes with their region's extent and depth) that meet the region, by the cell index."""
    index = bounded_broadcast_by(cells, F.size("edges") + 1, known_total=cells_total)
    return regioncells.clipped(cand).join(index, regioncells.KEY).where(regioncells.block_meets_box())


EXTENT = ["rx0", "ry0", "rx1", "ry1", "depth"]


def meets_box(region: DataFrame, changeset: DataFrame, contributor: DataFrame) -> DataFrame:
    """G6 on candidate pairs: (changeset, hot_project) where the author contributes and the box meets the region.

    Candidates come from the equi-join on uid; no period, area or validity test.
    Features of one project make up its region.
    """
    regions = region_edges(region.groupBy("hot_project").agg(F.flatten(F.collect_list("geom")).alias("geom")))
    proj = contributor.select("uid", "hot_project").join(regions.select("hot_project", *EXTENT), "hot_project")
    cand = _boxes(changeset).join(bounded_broadcast(proj), "uid").where(_box_meets_extent())
    return _by_cells(cand, regioncells.region_cells(regions)).select("changeset", "hot_project")


def in_period(changeset: DataFrame, contributor: DataFrame, activity: DataFrame) -> DataFrame:
    """J5 + J7: (changeset, hot_project) where the author contributes and the dates overlap the activity period."""
    proj = contributor.select("uid", "hot_project").join(
        activity.select("hot_project", F.col("first_date").alias("a_first"), F.col("last_date").alias("a_last")),
        "hot_project",
    )
    return (
        changeset.select("changeset", "uid", "first_date", "last_date")
        .join(
            bounded_broadcast(proj),
            (changeset["uid"] == proj["uid"])
            & _overlaps_period(changeset["first_date"], changeset["last_date"], proj["a_first"], proj["a_last"]),
        )
        .select("changeset", "hot_project")
    )


def project_areas(region: DataFrame, activity: DataFrame, description: DataFrame) -> DataFrame:
    """J4-J6 + P5 + G4 + G5 at project level: visible projects with a usable region.

    One row per project: hot_project, a_first, a_last, edges, rx0, ry0, rx1, ry1, depth.
    Small (one row per project) and worth storing once per run.
    """
    visible = description.where(~F.col("is_private") & ~F.col("is_draft")).select("hot_project")
    period = activity.select("hot_project", F.col("first_date").alias("a_first"), F.col("last_date").alias("a_last"))
    return usable_regions(region).join(visible, "hot_project", "left_semi").join(period, "hot_project")


def project_side(areas: DataFrame, contributor: DataFrame) -> DataFrame:
    """One row per (uid, project) a contributor may be assigned to, with period and region extent."""
    return contributor.select("uid", "hot_project").join(
        areas.select("hot_project", "a_first", "a_last", *EXTENT), "hot_project"
    )


def assign_rows(
    changeset: DataFrame,
    region: DataFrame,
    contributor: DataFrame,
    activity: DataFrame,
    description: DataFrame,
    max_m2: float = geo.MAX_BOX_AREA_M2,
) -> DataFrame:
    """J8 + J10 in one pass: every changeset column plus hot_project, one row per assignment."""
    return assign_to_areas(changeset, project_areas(region, activity, description), contributor, max_m2)


def assign_to_areas(
    changeset: DataFrame,
    areas: DataFrame,
    contributor: DataFrame,
    max_m2: float = geo.MAX_BOX_AREA_M2,
    cells: DataFrame | None = None,
    cells_total: int | None = None,
) -> DataFrame:
    """``assign_rows`` with the project level already built by ``project_areas``.

    The changeset rows stream through two broadcast joins (each behind a
    measured bound) and keep their columns, so consumers need no join back to
    ``changeset``. ``cells`` is the cell index of the regions and
    ``cells_total`` its measured size (edges and rows), where they are stored.
    """
    proj = project_side(areas, contributor)
    boxes = changeset.where(geo.box_is_small("min_lat", "max_lat", "min_lon", "max_lon", max_m2))
    on = F.lit(True)
    if fits_broadcast(proj):
        proj = F.broadcast(proj)
    else:
        boxes, proj = spread(boxes, proj, "uid")
        on = boxes["_salt"] == proj["_salt"]
    cand = boxes.join(
        proj,
        (boxes["uid"] == proj["uid"])
        & on
        & _overlaps_period(boxes["first_date"], boxes["last_date"], proj["a_first"], proj["a_last"])
        & _box_meets_extent(),
    ).select(*[boxes[c] for c in changeset.columns], *[proj[c] for c in ("hot_project", *EXTENT)])
    cells = regioncells.region_cells(areas) if cells is None else cells
    return _by_cells(cand, cells, cells_total).select(*changeset.columns, "hot_project")


def assign(
    changeset: DataFrame,
    region: DataFrame,
    contributor: DataFrame,
    activity: DataFrame,
    description: DataFrame,
    max_m2: float = geo.MAX_BOX_AREA_M2,
) -> DataFrame:
    """(changeset, hot_project) for every project a changeset is assigned to (no DISTINCT, as the reference)."""
    return assign_rows(changeset, region, contributor, activity, description, max_m2).select("changeset", "hot_project")
