"""Geometry as native column expressions.

Boxes are four doubles (min_lat, max_lat, min_lon, max_lon). A project region is
a multi-polygon in GeoJSON coordinate order, ``array<array<array<array<double>>>>``
(polygon -> ring -> point -> [lon, lat]); ``region_edges`` turns it into an
array of ``struct<x1,y1,x2,y2>`` segments. Everything here is a Column
expression evaluated inside the JVM: no Python UDF is involved.

All coordinates share one planar lon/lat space, as in the reference.
"""

from __future__ import annotations

import math

from numpy.polynomial.legendre import leggauss
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# WGS84 first eccentricity squared and semi-minor axis in metres.
WGS84_E2 = 0.0066943799901413165
WGS84_B = 6356752.314245179
# Latitude half-width of the strip around the equator that the box area leaves out.
EQUATOR_GAP_LAT = 0.0001
# World bounds: min_lat, max_lat, min_lon, max_lon.
WORLD_BOX = (-90.0, 90.0, -180.0, 180.0)
# Largest changeset box that still counts as local work: 100 km2.
MAX_BOX_AREA_M2 = 100.0 * 1000.0 * 1000.0
# ---------------------------------------------------------------------------

_E = math.sqrt(WGS84_E2)
# Degrees of longitude up to which the closed form of a geodesic side is used, and from which sides follow the parallels.
NARROW_LON = 2.0
WIDEST_LON = 179.0
# Gauss nodes over half a side, and steps of the fixed point.
_NODES = 24
CIRCLE_STEPS = 6


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


# --------------------------------------------------------------------------- G1, G7

def bbox_wkt(min_lat, max_lat, min_lon, max_lon, decimals: int = 7) -> Column:
    """G1: the closed five-point box polygon as WKT; NULL when the box has no coordinates.

    Corner order follows the reference: (min_lon min_lat), (max_lon min_lat),
    (max_lon max_lat), (min_lon max_lat), back to the start. Seven decimals keep
    the full precision of OSM coordinates.
    """
    a, b, c, d = _c(min_lat), _c(max_lat), _c(min_lon), _c(max_lon)
    p = f"%.{decimals}f %.{decimals}f"
    fmt = "POLYGON((" + ",".join([p] * 5) + "))"
    text = F.format_string(fmt, c, a, d, a, d, b, c, b, c, a)
    return F.when(a.isNotNull(), text)


# --------------------------------------------------------------------------- G2, G8

def _q_of_sine(s: Column) -> Column:
    return s / (F.lit(1.0) - F.lit(WGS84_E2) * s * s) + F.log((F.lit(1.0) + F.lit(_E) * s) / (F.lit(1.0) - F.lit(_E) * s)) / F.lit(2.0 * _E)


def _authalic_q(lat: Column) -> Column:
    return _q_of_sine(F.sin(F.radians(lat)))


def _band_area(lat1: Column, lat2: Column, lon1: Column, lon2: Column) -> Column:
    """Area between two parallels and two meridians on the ellipsoid, 0 for empty or inverted boxes."""
    area = F.lit(WGS84_B * WGS84_B) * F.radians(lon2 - lon1) / F.lit(2.0) * (_authalic_q(lat2) - _authalic_q(lat1))
    return F.when(lat1 >= lat2, F.lit(0.0)).when(lon1 >= lon2, F.lit(0.0)).otherwise(area)


def _bulge(lat: Column, width: Column) -> Column:
    """Area between the geodesic that joins two points of a parallel, ``width`` radians apart, and the parallel.

    That of a sphere with the ellipsoid's radius across the meridian there: exact
    in the leading term, and short by the order of e^2 width^2 of itself.
    """
    s = F.sin(F.radians(lat))
    across = F.lit(WGS84_B**2 / (1.0 - WGS84_E2)) / (F.lit(1.0) - F.lit(WGS84_E2) * s * s)
    return across * (F.lit(2.0) * F.atan(s * F.tan(width / F.lit(2.0))) - width * s)


def _narrow_area(lat1: Column, lat2: Column, lon1: Column, lon2: Column) -> Column:
    """Area of a box with geodesic sides up to ``NARROW_LON`` wide, 0 for empty or inverted boxes."""
    width = F.radians(lon2 - lon1)
    area = _band_area(lat1, lat2, lon1, lon2) + _bulge(lat2, width) - _bulge(lat1, width)
    return F.when((lat1 >= lat2) | (lon1 >= lon2), F.lit(0.0)).otherwise(area)


def half_side_nodes() -> list[tuple[float, float]]:
    """Gauss nodes and weights on the unit interval."""
    return [((1 + float(x)) / 2, float(w) / 2) for x, w in zip(*leggauss(_NODES))]


def _under_geodesic(lat: Column, width: Column) -> Column:
    """Area between the equator and the geodesic that joins two points of a parallel, ``width`` radians apart.

    On the sphere of reduced latitudes the geodesic is a great circle with its
    top in the middle, and longitude grows by sqrt(1 - e^2 cos^2) of the circle's
    own. The circle's half width comes from a fixed point (each step gains two
    to three digits), the area from one more sum over the same Gauss nodes.
    """
    one, half = F.lit(1.0), width / F.lit(2.0)
    flat = F.lit(math.sqrt(1.0 - WGS84_E2))
    nodes = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(w).alias("w")) for x, w in half_side_nodes()])
    tan_low = flat * F.tan(F.radians(lat))

    def rate(tan_reduced: Column) -> Column:
        return F.sqrt(one - F.lit(WGS84_E2) / (one + tan_reduced * tan_reduced))

    def over_nodes(circle: Column, value) -> Column:
        return F.aggregate(
            nodes, F.lit(0.0), lambda total, n: total + n.w * value(tan_low / F.cos(circle) * F.cos(circle * n.x))
        )

    circle = F.aggregate(F.array(*[F.lit(0)] * CIRCLE_STEPS), half, lambda c, _: half / over_nodes(c, rate))

    def below(tan_reduced: Column) -> Column:
        t = tan_reduced / flat
        return _q_of_sine(t / F.sqrt(one + t * t)) * rate(tan_reduced)

    area = F.transform(F.array(circle), lambda c: F.lit(WGS84_B**2) * c * over_nodes(c, below))[0]
    along = F.lit(WGS84_B**2) * half * _authalic_q(lat)
    return F.when((width >= F.lit(math.radians(WIDEST_LON))) | (F.abs(lat) >= F.lit(89.999999)), along).otherwise(area)


def _wide_area(lat1: Column, lat2: Column, width: Column) -> Column:
    """Area of a box of any width with geodesic sides, without the strip at the equator where the box meets it."""
    gap = F.lit(EQUATOR_GAP_LAT)
    under = F.transform(F.array(lat1, lat2, gap), lambda lat: _under_geodesic(lat, width))

    def parts(u: Column) -> Column:
        south = F.when(lat1 < -gap, -u[2] - u[0]).otherwise(F.lit(0.0))
        north = F.when(lat2 > gap, u[1] - u[2]).otherwise(F.lit(0.0))
        return F.when((lat1 <= F.lit(0.0)) & (lat2 >= F.lit(0.0)), south + north).otherwise(u[1] - u[0])

    return F.transform(F.array(under), parts)[0]


def bbox_area_m2(min_lat, max_lat, min_lon, max_lon) -> Column:
    """Area in m2 of a lat/lon box on the WGS84 ellipsoid, with geodesic sides.

    Rules, in order: inverted or flat latitude -> 0; inverted or flat longitude -> 0;
    a box that meets the equator is measured as its parts south of -0.0001 and
    north of +0.0001 (each 0 if empty); else the whole box. The sides along
    meridians are geodesics themselves; the other two join the corners by the
    shortest way: a closed form up to ``NARROW_LON`` degrees, beyond that a sum over
    Gauss nodes. From ``WIDEST_LON`` degrees on, where the shortest way may pass a
    pole or go round the other side, sides run along the parallels.
    """
    a, b, c, d = _c(min_lat), _c(max_lat), _c(min_lon), _c(max_lon)
    gap = F.lit(EQUATOR_GAP_LAT)
    split = _narrow_area(a, -gap, c, d) + _narrow_area(gap, b, c, d)
    return (
        F.when(a >= b, F.lit(0.0))
        .when(c >= d, F.lit(0.0))
        .when(d - c > F.lit(NARROW_LON), _wide_area(a, b, F.radians(d - c)))
        .when((a <= F.lit(0.0)) & (b >= F.lit(0.0)), split)
        .otherwise(_narrow_area(a, b, c, d))
    )


def box_is_small(min_lat, max_lat, min_lon, max_lon, max_m2: float = MAX_BOX_AREA_M2) -> Column:
    """P6 + P7: the changeset has coordinates and its box area is at most ``max_m2`` (inclusive)."""
    return _c(min_lat).isNotNull() & (bbox_area_m2(min_lat, max_lat, min_lon, max_lon) <= F.lit(float(max_m2)))


# --------------------------------------------------------------------------- region geometry

def region_points(geom) -> Column:
    """All vertices of a multi-polygon, as ``array<array<double>>``."""
    return F.flatten(F.flatten(_c(geom)))


def _ring_edges(ring: Column, part: Column, number: Column) -> Column:
    """Segments of a ring, without repeated points; ``k`` of ``n`` is the segment's place in the ring."""
    own = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.size(ring) - 2),
            lambda i: F.struct(
                ring[i][0].alias("x1"), ring[i][1].alias("y1"), ring[i + 1][0].alias("x2"), ring[i + 1][1].alias("y2")
            ),
        ),
        lambda e: (e.x1 != e.x2) | (e.y1 != e.y2),
    )
    return F.transform(
        own,
        lambda e, k: F.struct(
            e.x1.alias("x1"), e.y1.alias("y1"), e.x2.alias("x2"), e.y2.alias("y2"),
            part.alias("part"), number.alias("ring"), k.alias("k"), F.size(own).alias("n"),
        ),
    )


def region_edges(geom) -> Column:
    """Segments of every ring of every polygon, polygon by polygon; rings with fewer than 2 points give none."""

    def part_edges(p: Column, i: Column) -> Column:
        return F.flatten(F.transform(F.filter(p, lambda r: F.size(r) >= 2), lambda r, j: _ring_edges(r, i, j)))

    return F.flatten(F.transform(_c(geom), part_edges))


def region_extent(geom) -> list[Column]:
    """min_x, min_y, max_x, max_y of all vertices."""
    pts = region_points(geom)
    xs = F.transform(pts, lambda p: p[0])
    ys = F.transform(pts, lambda p: p[1])
    return [F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)]


def rings_closed(geom) -> Column:
    """Every ring has at least 4 points and ends where it starts (first part of G4)."""
    return F.forall(
        F.flatten(_c(geom)),
        lambda r: (F.size(r) >= 4) & (r[0][0] == F.element_at(r, -1)[0]) & (r[0][1] == F.element_at(r, -1)[1]),
    )


def within_world(geom) -> Column:
    """G3 + G5: ``ST_Contains(world box, region)``, boundary included; a region without points is in nothing."""
    min_lat, max_lat, min_lon, max_lon = WORLD_BOX
    x0, y0, x1, y1 = region_extent(geom)
    inside = (x0 >= F.lit(min_lon)) & (x1 <= F.lit(max_lon)) & (y0 >= F.lit(min_lat)) & (y1 <= F.lit(max_lat))
    return F.coalesce(inside, F.lit(False))


def _orient(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """Sign-carrying cross product of (b - a) and (p - a)."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def segments_cross(a: Column, b: Column) -> Column:
    """Proper crossing of two segments: they meet in one point inside both (touching ends do not count)."""
    o1 = _orient(a.x1, a.y1, a.x2, a.y2, b.x1, b.y1)
    o2 = _orient(a.x1, a.y1, a.x2, a.y2, b.x2, b.y2)
    o3 = _orient(b.x1, b.y1, b.x2, b.y2, a.x1, a.y1)
    o4 = _orient(b.x1, b.y1, b.x2, b.y2, a.x2, a.y2)
    return (o1 * o2 < F.lit(0.0)) & (o3 * o4 < F.lit(0.0))


def on_segment(e: Column, px: Column, py: Column) -> Column:
    """The point lies on the closed segment."""
    return (
        (_orient(e.x1, e.y1, e.x2, e.y2, px, py) == F.lit(0.0))
        & px.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2))
        & py.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2))
    )


def segments_touch(a: Column, b: Column) -> Column:
    """An end of one segment lies on the other."""
    return (
        on_segment(a, b.x1, b.y1) | on_segment(a, b.x2, b.y2) | on_segment(b, a.x1, a.y1) | on_segment(b, a.x2, a.y2)
    )


def segments_overlap(a: Column, b: Column) -> Column:
    """Two segments on one line share more than a point."""
    zero = F.lit(0.0)
    one_line = (_orient(a.x1, a.y1, a.x2, a.y2, b.x1, b.y1) == zero) & (_orient(a.x1, a.y1, a.x2, a.y2, b.x2, b.y2) == zero)

    def common(u: str, v: str) -> Column:
        ends = [F.greatest(e[u], e[v]) for e in (a, b)]
        starts = [F.least(e[u], e[v]) for e in (a, b)]
        return F.least(*ends) > F.greatest(*starts)

    return one_line & (common("x1", "x2") | common("y1", "y2"))


def edges_conflict(a: Column, b: Column) -> Column:
    """Two edges of one region that no valid region has.

    They cross, they overlap along a line, or they belong to one ring, are not
    neighbours and touch. Different rings may touch in points.
    """
    apart = F.abs(a.k - b.k)
    neighbours = (apart == F.lit(1)) | (apart == a.n - F.lit(1))
    one_ring = (a.part == b.part) & (a.ring == b.ring)
    return segments_cross(a, b) | segments_overlap(a, b) | (one_ring & ~neighbours & segments_touch(a, b))


def _ring_holds(ring: Column, px: Column, py: Column) -> Column:
    return ray_crossings(_ring_edges(ring, F.lit(0), F.lit(0)), px, py) % 2 == 1


def _mid(ring: Column) -> tuple[Column, Column]:
    """Middle of a ring's first edge: a point of the ring that other rings may meet only by overlapping or crossing."""
    two = F.lit(2.0)
    return (ring[0][0] + ring[1][0]) / two, (ring[0][1] + ring[1][1]) / two


def nesting_ok(geom) -> Column:
    """Holes lie in their shell and not in each other; no polygon lies in another one (rest of G4).

    Together with ``edges_conflict``: rings that do not cross lie inside or
    outside each other as a whole, so one point of each decides.
    """
    polygons = _c(geom)

    def holds(p: Column, x: Column, y: Column) -> Column:
        return F.aggregate(p, F.lit(0), lambda n, r: n + F.when(_ring_holds(r, x, y), F.lit(1)).otherwise(F.lit(0))) % 2 == 1

    def holes_ok(p: Column) -> Column:
        holes = F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0)))
        each = F.transform(
            holes,
            lambda h, i: _ring_holds(p[0], *_mid(h))
            & ~F.exists(F.transform(holes, lambda g, j: (i != j) & _ring_holds(g, *_mid(h))), lambda bad: bad),
        )
        return F.forall(each, lambda ok: ok)

    def polygon_ok(p: Column, i: Column) -> Column:
        inside = F.transform(polygons, lambda q, j: (i != j) & holds(q, *_mid(p[0])))
        return (F.size(p) == 0) | (holes_ok(p) & ~F.exists(inside, lambda bad: bad))

    return F.forall(F.transform(polygons, polygon_ok), lambda ok: ok)


def edge_meets_box(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed segment meets closed box: extents overlap and the box corners are not all on one side."""
    overlap = (
        (F.least(e.x1, e.x2) <= x1) & (F.greatest(e.x1, e.x2) >= x0)
        & (F.least(e.y1, e.y2) <= y1) & (F.greatest(e.y1, e.y2) >= y0)
    )
    sides = [_orient(e.x1, e.y1, e.x2, e.y2, cx, cy) for cx, cy in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]
    one_side = (F.least(*sides) > F.lit(0.0)) | (F.greatest(*sides) < F.lit(0.0))
    return overlap & ~one_side


def ray_crossings(edges: Column, px: Column, py: Column) -> Column:
    """Number of edges crossed by the ray from (px, py) towards +x (even-odd rule)."""

    def step(acc: Column, e: Column) -> Column:
        straddles = (e.y1 > py) != (e.y2 > py)
        x_at = e.x1 + F.try_divide((py - e.y1) * (e.x2 - e.x1), e.y2 - e.y1)
        return acc + F.when(straddles & (px < x_at), F.lit(1)).otherwise(F.lit(0))

    return F.aggregate(edges, F.lit(0), step)


def region_holds_point(edges: Column, px: Column, py: Column) -> Column:
    """Some polygon of the region holds the point (even-odd inside each polygon, so its holes come out right).

    One pass over the edges, which lie polygon by polygon.
    """

    def step(acc: Column, e: Column) -> Column:
        same = acc.part == e.part
        odd = F.when(same, acc.odd).otherwise(F.lit(0))
        found = acc.found | (~same & (acc.odd == F.lit(1)))
        crosses = ray_crossings(F.array(e), px, py)
        return F.struct(e.part.cast("int").alias("part"), ((odd + crosses) % 2).alias("odd"), found.alias("found"))

    start = F.struct(F.lit(-1).alias("part"), F.lit(0).alias("odd"), F.lit(False).alias("found"))
    return F.aggregate(edges, start, step, lambda acc: acc.found | (acc.odd == F.lit(1)))


def region_meets_box(edges, x0, y0, x1, y1) -> Column:
    """``ST_Intersects(region, box)`` with closed sets.

    Either some edge meets the box, or no edge does and the box lies wholly
    inside some polygon of the region or outside all of them.
    """
    edges, x0, y0, x1, y1 = _c(edges), _c(x0), _c(y0), _c(x1), _c(y1)
    touches = F.exists(edges, lambda e: edge_meets_box(e, x0, y0, x1, y1))
    return touches | region_holds_point(edges, x0, y0)
