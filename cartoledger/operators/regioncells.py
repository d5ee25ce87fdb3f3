"""Cell index of project regions for the box test.

A region's extent is halved into 2, 4, 8 ... cells a side. On each level an
index row holds the edges that cross a block of two by two cells, named by its
lower left cell, and the polygons that hold that cell's reference point. A box
takes the finest level on which it lies in one block, so it meets its region
by one equi-join on (project, level, cell) and only the edges of that block are
tested. If none of them meets the box, the box lies in one piece inside or
outside every polygon: its corner decides, by the edges between it and the
reference point of its cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo

# The finest level has about so many edges to a cell; no more than MAX_DEPTH halvings.
EDGES_A_CELL = 4
MAX_DEPTH = 12
# Place of a cell's reference point inside the cell, away from borders, corners and diagonals.
REFERENCE = (0.3819660112501051, 0.6235)
# Room for rounding where an edge is cut at cell borders; an edge too many in a cell does no harm.
_ROOM = 1e-12

KEY = ["hot_project", "level", "cx", "cy"]


def depth(edges: Column) -> Column:
    """Finest level of a region with that edge list."""
    per_side = F.log2(F.size(edges) / F.lit(float(EDGES_A_CELL))) / F.lit(2.0)
    return F.when(F.size(edges) > EDGES_A_CELL, F.least(F.ceil(per_side), F.lit(MAX_DEPTH))).otherwise(F.lit(0)).cast("int")


def _sides(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def cell(v: Column, low: Column, high: Column, level: Column) -> Column:
    """Number of the cell that holds ``v``, in order of ``v`` and within the extent; a flat extent is one cell."""
    place = F.coalesce(F.try_divide(v - low, high - low), F.lit(0.0)) * _sides(level)
    number = F.greatest(F.lit(0.0), F.least(_sides(level) - F.lit(1.0), F.floor(place).cast("double"))).cast("int")
    return F.coalesce(number, F.lit(0))


def cross_cells(edges: DataFrame, span: int = 1, within: list[Column] | None = None) -> DataFrame:
    """Rows of ``edges(e, rx0, ry0, rx1, ry1, level)`` for each cell ``cx, cy`` that the edge crosses, along its line.

    With ``span`` 2, for each block of two by two cells, named by its lower left
    cell. ``within``: first and last column, first and last row to look at.
    """
    c = F.col
    left, right = F.least("e.x1", "e.x2"), F.greatest("e.x1", "e.x2")
    forward = c("e.x1") <= c("e.x2")
    line = edges.select(
        "*", left.alias("_left"), right.alias("_right"),
        F.least("e.y1", "e.y2").alias("_low"), F.greatest("e.y1", "e.y2").alias("_high"),
        F.when(forward, c("e.y1")).otherwise(c("e.y2")).alias("_start"),
        F.when(forward, c("e.y2")).otherwise(c("e.y1")).alias("_end"),
        ((c("rx1") - c("rx0")) / _sides(c("level"))).alias("_w"),
    )
    line = line.select(
        "*",
        cell(c("_left"), c("rx0"), c("rx1"), c("level")).alias("_first"),
        cell(c("_right"), c("rx0"), c("rx1"), c("level")).alias("_last"),
    )
    most = [F.lit(0), c("_last"), F.lit(0), _sides(c("level")).cast("int")] if within is None else within
    columns = line.select(
        "*", F.greatest(c("_first") - (span - 1), most[0]).alias("_from"), F.least(c("_last"), most[1]).alias("_to")
    ).where(c("_from") <= c("_to"))
    columns = columns.select("*", F.explode(F.sequence("_from", "_to")).alias("cx"))

    def at(x: Column) -> Column:
        t = F.coalesce(F.try_divide(x - c("_left"), c("_right") - c("_left")), F.lit(0.0))
        return c("_start") + F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)) * (c("_end") - c("_start"))

    room = F.lit(_ROOM) * (F.abs("_left") + F.abs("_right") + F.lit(1.0))
    up = F.lit(_ROOM) * (F.abs("_low") + F.abs("_high") + F.lit(1.0))
    columns = columns.select(
        "*", up.alias("_up"),
        at(c("rx0") + c("cx") * c("_w") - room).alias("_a"), at(c("rx0") + (c("cx") + span) * c("_w") + room).alias("_b"),
    )
    upright = c("_first") == c("_last")
    columns = columns.select(
        "*",
        F.when(upright, c("_low")).otherwise(F.greatest(c("_low"), F.least("_a", "_b") - c("_up"))).alias("_bottom"),
        F.when(upright, c("_high")).otherwise(F.least(c("_high"), F.greatest("_a", "_b") + c("_up"))).alias("_top"),
    )
    columns = columns.select(
        "*",
        F.greatest(cell(c("_bottom"), c("ry0"), c("ry1"), c("level")) - (span - 1), most[2]).alias("_r0"),
        F.least(cell(c("_top"), c("ry0"), c("ry1"), c("level")), most[3]).alias("_r1"),
    ).where(c("_r0") <= c("_r1"))
    return columns.select(*edges.columns, "cx", F.explode(F.sequence("_r0", "_r1")).alias("cy"))


def _left_of(e: Column, px: Column, py: Column) -> Column:
    """Whether the point lies left of the directed edge; one on its line is taken a little to the right and up."""
    d = (e.x2 - e.x1) * (py - e.y1) - (e.y2 - e.y1) * (px - e.x1)
    on = (e.y2 < e.y1) | ((e.y2 == e.y1) & (e.x2 > e.x1))
    return (d > F.lit(0.0)) | ((d == F.lit(0.0)) & on)


def _reference(low: Column, high: Column, number: Column, level: Column, share: float) -> Column:
    return low + (number + F.lit(share)) * ((high - low) / _sides(level))


def region_cells(regions: DataFrame) -> DataFrame:
    """Index rows ``(hot_project, level, cx, cy, edges, odd)`` of regions ``(hot_project, edges, rx0, ry0, rx1, ry1)``.

    One region per project. ``odd`` lists the polygons (numbers of ``part``) that
    hold the cell's reference point. Blocks without edges outside every polygon
    have no row.
    """
    x0, y0, x1, y1 = (F.col(c) for c in ("rx0", "ry0", "rx1", "ry1"))
    e, level = F.col("e"), F.col("level")
    edges = regions.select("hot_project", "rx0", "ry0", "rx1", "ry1", depth(F.col("edges")).alias("d"), F.explode("edges").alias("e"))
    edges = edges.select("*", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("level"))

    slim = F.struct("e.x1", "e.y1", "e.x2", "e.y2", "e.part")
    held = cross_cells(edges, 2).select(*KEY, slim.alias("edge"), F.lit(None).cast("int").alias("part"))

    # Where the edges cross the height of the reference points of a row of cells, from right to left.
    rows = F.sequence(cell(F.least("e.y1", "e.y2"), y0, y1, level), cell(F.greatest("e.y1", "e.y2"), y0, y1, level))
    crossing = edges.select("*", F.explode(rows).alias("cy"))
    height = _reference(y0, y1, F.col("cy"), level, REFERENCE[1])
    crossing = crossing.where((F.col("e.y1") > height) != (F.col("e.y2") > height))
    x_at = F.col("e.x1") + F.try_divide((height - F.col("e.y1")) * (F.col("e.x2") - F.col("e.x1")), F.col("e.y2") - F.col("e.y1"))
    column = cell(x_at, x0, x1, level)
    beyond = _left_of(e, _reference(x0, x1, column, level, REFERENCE[0]), height) == (F.col("e.y2") > F.col("e.y1"))
    line = ["hot_project", "level", "cy", "part"]
    crossing = crossing.select("hot_project", "level", "cy", F.col("e.part").alias("part"), column.alias("cx"), beyond.alias("beyond"))
    crossing = (
        crossing.repartition(*line)
        .groupBy(*line, "cx")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("beyond")).alias("m"))
    )
    leftwards = Window.partitionBy(*line).orderBy(F.desc("cx"))
    right = F.coalesce(F.sum("n").over(leftwards.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    crossing = crossing.select("*", right.alias("right"), F.coalesce(F.lead("cx").over(leftwards), F.lit(-1)).alias("next"))
    none = F.array().cast("array<int>")
    here = F.when((F.col("right") + F.col("m")) % 2 == 1, F.array("cx")).otherwise(none)
    between = ((F.col("right") + F.col("n")) % 2 == 1) & (F.col("next") + 1 < F.col("cx"))
    gap = F.when(between, F.sequence(F.col("next") + 1, F.col("cx") - 1)).otherwise(none)
    marks = crossing.select(
        "hot_project", "level", F.explode(F.concat(here, gap)).alias("cx"), "cy",
        F.lit(None).cast(held.schema["edge"].dataType).alias("edge"), "part",
    )
    return (
        held.unionByName(marks)
        .groupBy(*KEY)
        .agg(F.collect_list("edge").alias("edges"), F.collect_list("part").alias("odd"))
    )


def clipped(boxes: DataFrame) -> DataFrame:
    """Boxes that meet their region's extent, cut to it (``bx0, by0, bx1, by1``), with ``level, cx, cy`` of their block.

    Needs min_lon, min_lat, max_lon, max_lat, rx0, ry0, rx1, ry1 and depth.
    """
    own = boxes.select(
        "*",
        F.greatest("min_lon", "rx0").alias("bx0"), F.greatest("min_lat", "ry0").alias("by0"),
        F.least("max_lon", "rx1").alias("bx1"), F.least("max_lat", "ry1").alias("by1"),
    )

    def fits(low: str, high: str, b0: str, b1: str) -> Column:
        """Halvings after which a cell is still as wide as the box."""
        share = F.try_divide(F.col(high) - F.col(low), F.col(b1) - F.col(b0))
        return F.when(share >= 1, F.floor(F.log2(share))).otherwise(F.when(share.isNull(), F.col("depth")).otherwise(F.lit(0)))

    finest = F.least(F.col("depth"), fits("rx0", "rx1", "bx0", "bx1"), fits("ry0", "ry1", "by0", "by1")).cast("int")
    # Join keys that cannot be null: a filter on them would be pushed below all these steps, written out in full.
    own = own.select("*", F.coalesce(finest, F.lit(0)).alias("_l"))

    def spans(b0: str, b1: str, low: str, high: str) -> Column:
        ends = [cell(F.col(b), F.col(low), F.col(high), F.col("_l")) for b in (b0, b1)]
        return ends[1] - ends[0] > 1

    # Rounding of the logarithm may give a level too fine; one coarser, the box is half a cell wide.
    wide = spans("bx0", "bx1", "rx0", "rx1") | spans("by0", "by1", "ry0", "ry1")
    own = own.select("*", F.when(wide, F.greatest(F.col("_l") - 1, F.lit(0))).otherwise(F.col("_l")).alias("level")).drop("_l")
    return own.select(
        "*",
        cell(F.col("bx0"), F.col("rx0"), F.col("rx1"), F.col("level")).alias("cx"),
        cell(F.col("by0"), F.col("ry0"), F.col("ry1"), F.col("level")).alias("cy"),
    )


def block_meets_box() -> Column:
    """Whether the region meets the box, from a row of ``clipped`` boxes joined to its row of ``region_cells``."""
    edges, level = F.col("edges"), F.col("level")
    px, py = F.col("bx0"), F.col("by0")
    rx = _reference(F.col("rx0"), F.col("rx1"), F.col("cx"), level, REFERENCE[0])
    ry = _reference(F.col("ry0"), F.col("ry1"), F.col("cy"), level, REFERENCE[1])

    def between(e: Column) -> Column:
        """The way from the box's corner along its height, then up or down to the reference point, crosses the edge once."""
        turn = _left_of(e, rx, py)
        along = ((e.y1 > py) != (e.y2 > py)) & (_left_of(e, px, py) != turn)
        up = ((e.x1 > rx) != (e.x2 > rx)) & (turn != _left_of(e, rx, ry))
        return along != up

    touches = F.exists(edges, lambda e: geo.edge_meets_box(e, px, py, F.col("bx1"), F.col("by1")))
    flips = F.concat(F.col("odd"), F.transform(F.filter(edges, between), lambda e: e.part))
    inside = F.exists(F.array_distinct(flips), lambda q: F.size(F.filter(flips, lambda z: z == q)) % 2 == 1)
    return touches | inside
