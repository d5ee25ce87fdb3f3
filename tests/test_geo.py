"""G1-G6, P7 hand cases."""

import math

import pytest

from pyspark.sql import functions as F

from cartoledger.functions import geo
from cartoledger.operators import assign


def _area(spark, a, b, c, d):
    df = spark.createDataFrame([(a, b, c, d)], "a double, b double, c double, d double")
    return df.select(geo.bbox_area_m2("a", "b", "c", "d").alias("x")).first().x


def test_area_rules(spark):
    assert _area(spark, 1.0, 1.0, 0.0, 1.0) == 0.0  # flat
    assert _area(spark, 1.0, 2.0, 3.0, 3.0) == 0.0  # line
    assert _area(spark, 2.0, 1.0, 0.0, 1.0) == 0.0  # inverted
    assert _area(spark, None, None, None, None) is None
    df = spark.createDataFrame([(-90.0, 90.0, -180.0, 180.0)], "a double, b double, c double, d double")
    whole = df.select(geo._band_area(df.a, df.b, df.c, df.d).alias("x")).first().x
    assert whole == pytest.approx(5.10065621724e14, rel=1e-9)  # the WGS84 total
    strip = whole - _area(spark, -90.0, 90.0, -180.0, 180.0)  # the 0.0002 degree equator strip is left out
    assert strip == pytest.approx(0.0002 * 110574.0 * 40075016.7, rel=1e-3)  # 22 m times the equator
    # min_lat = 0 counts as meeting the equator: the strip up to 0.0001 is left out
    assert _area(spark, 0.0, 1.0, 0.0, 1.0) == pytest.approx(_area(spark, 0.0001, 1.0, 0.0, 1.0), rel=1e-12)
    assert _area(spark, 0.0, 0.00005, 0.0, 1.0) == 0.0


def test_area_closed_form_value(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "l1 double, l2 double")
    band = geo._band_area(df.l1, df.l2, df.l1, df.l2)  # 1 x 1 degree from the equator, no strip rule
    v = df.select(band.alias("v")).first().v
    assert v == pytest.approx(12308463893.98, abs=0.1)


def test_area_between_parallels_additive_in_longitude(spark):
    df = spark.createDataFrame([(10.0, 11.0, 0.0, 1.0, 2.0)], "a double, b double, c double, d double, e double")
    one, two = geo._band_area(df.a, df.b, df.c, df.d), geo._band_area(df.a, df.b, df.c, df.e)
    r = df.select(one.alias("one"), two.alias("two")).first()
    assert r.two == pytest.approx(2 * r.one, rel=1e-12) and r.one > 0
    assert _area(spark, 10.0, 11.0, 0.0, 2.0) > r.two  # geodesic sides bend towards the pole, the northern one more


def test_small_area_inclusive(spark):
    df = spark.createDataFrame([(1, 0.5, 0.55, 0.5, 0.55), (2, None, None, None, None), (3, 10.0, 20.0, 10.0, 20.0)],
                               "changeset int, min_lat double, max_lat double, min_lon double, max_lon double")
    got = {r.changeset for r in df.where(geo.box_is_small("min_lat", "max_lat", "min_lon", "max_lon")).collect()}
    assert got == {1}
    limit = _area(spark, 0.5, 0.55, 0.5, 0.55)
    exact = {r.changeset for r in df.where(geo.box_is_small("min_lat", "max_lat", "min_lon", "max_lon", limit)).collect()}
    assert 1 in exact  # exactly at the limit is kept


def _square(x0, y0, x1, y1):
    x0, y0, x1, y1 = (float(v) for v in (x0, y0, x1, y1))
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


def _regions(spark, data):
    return spark.createDataFrame(data, "hot_project int, geom array<array<array<array<double>>>>")


def test_meets_box_cases(spark):
    outer = _square(0, 0, 10, 10)
    hole = _square(4, 4, 6, 6)
    regions = _regions(spark, [(1, [[outer, hole]]), (2, [[_square(0, 0, 1, 1)], [_square(20, 20, 21, 21)]])])
    boxes = [
        (1, 1, 10.0, 11.0, 10.0, 11.0),  # touches the corner
        (2, 1, 5.0, 5.0, 10.0, 12.0),  # touches an edge (point on edge)
        (3, 1, 1.0, 2.0, 1.0, 2.0),  # inside
        (4, 1, -1.0, 11.0, -1.0, 11.0),  # region inside box
        (5, 1, 4.5, 5.5, 4.5, 5.5),  # box in the hole
        (6, 1, 11.0, 12.0, 11.0, 12.0),  # outside
        (7, 2, 20.2, 20.3, 20.2, 20.3),  # second part only
        (8, 1, 5.0, 5.0, 5.0, 5.0),  # point in the hole
        (9, 1, 2.0, 2.0, 2.0, 2.0),  # point inside
    ]
    b = spark.createDataFrame(boxes, "changeset int, hot_project int, min_lat double, max_lat double, min_lon double, max_lon double")
    r = assign.region_edges(regions)
    got = b.join(r, "hot_project").where(geo.region_meets_box("edges", "min_lon", "min_lat", "max_lon", "max_lat"))
    assert {x.changeset for x in got.collect()} == {1, 2, 3, 4, 7, 9}


def test_valid_and_world(spark):
    bowtie = [[0.0, 0.0], [1.0, 1.0], [1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]
    open_ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]
    regions = _regions(spark, [
        (1, [[_square(0, 0, 1, 1)]]),
        (2, [[bowtie]]),
        (3, [[open_ring]]),
        (4, [[_square(179, 0, 180, 1)]]),
        (5, [[_square(179, 0, 180.1, 1)]]),
        (6, [[_square(0, 0, 10, 10), _square(4, 4, 6, 6)]]),
    ])
    valid = dict((r.hot_project, r.is_valid) for r in assign.region_valid(regions).collect())
    assert valid == {1: True, 2: False, 3: False, 4: True, 5: True, 6: True}
    world = dict((r.hot_project, r.in_world) for r in assign.region_in_world(regions).collect())
    assert world[4] is True and world[5] is False


def test_invalid_shapes(spark):
    """ST_IsValid on shapes that close and do not cross: touching, nested, repeated, misplaced holes, overlaps."""
    touching = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [2.0, 0.0], [0.0, 4.0], [0.0, 0.0]]  # a vertex on another edge
    spike = [[0.0, 0.0], [2.0, 0.0], [4.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 0.0]]  # folds back on itself
    big, small, far = _square(0, 0, 10, 10), _square(4, 4, 6, 6), _square(20, 20, 21, 21)
    regions = _regions(spark, [
        (1, [[touching]]),
        (2, [[big], [small]]),  # a part inside a part
        (3, [[small], [small]]),  # the same part twice
        (4, [[big, far]]),  # hole outside its shell
        (5, [[spike]]),
        (6, [[big, _square(1, 1, 8, 8), small]]),  # hole in a hole
        (7, [[_square(0, 0, 2, 2)], [_square(2, 0, 4, 2)]]),  # two parts share an edge
        (8, [[_square(0, 0, 2, 2)], [_square(2, 2, 4, 4)]]),  # two parts touch in a point: valid
        (9, [[big, small], [_square(4.5, 4.5, 5.5, 5.5)]]),  # an island in the hole: valid
        (10, [[big], [far]]),
        (11, []),
    ])
    valid = {r.hot_project: r.is_valid for r in assign.region_valid(regions).collect()}
    assert {k for k, v in valid.items() if v} == {8, 9, 10, 11}
    world = {r.hot_project: r.in_world for r in assign.region_in_world(regions).collect()}
    assert world[11] is False and all(world[k] for k in range(1, 11))


def test_box_inside_overlapping_parts(spark):
    regions = _regions(spark, [(1, [[_square(0, 0, 10, 10)], [_square(2, 2, 12, 12)]]), (2, [[_square(0, 0, 9, 9), _square(3, 3, 6, 6)], [_square(20, 0, 30, 9)]])])
    boxes = spark.createDataFrame([(1, 4.0), (2, 4.0), (2, 1.0), (2, 21.0), (2, 15.0)], "hot_project int, x double")
    x, y = F.col("x"), F.when(F.col("x") > 9, 4.0).otherwise(F.col("x"))
    got = boxes.join(assign.region_edges(regions), "hot_project").where(geo.region_meets_box("edges", x, y, x + 0.5, y + 0.5))
    assert sorted((r.hot_project, r.x) for r in got.collect()) == [(1, 4.0), (2, 1.0), (2, 21.0)]


def test_features_are_valid_on_their_own(spark):
    """Two overlapping features of one project: each valid, so the project keeps both."""
    regions = _regions(spark, [(1, [[_square(0, 0, 2, 2)]]), (1, [[_square(1, 1, 3, 3)]]), (2, [[_square(0, 0, 2, 2)], [_square(1, 1, 3, 3)]])])
    got = {r.hot_project: len(r.edges) for r in assign.usable_regions(regions).collect()}
    assert got == {1: 8}


def test_bbox_wkt(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0), (None, None, None, None)], "a double, b double, c double, d double")
    out = [r.w for r in df.select(geo.bbox_wkt("a", "b", "c", "d").alias("w")).collect()]
    assert out[0] == "POLYGON((3.0000000 1.0000000,4.0000000 1.0000000,4.0000000 2.0000000,3.0000000 2.0000000,3.0000000 1.0000000))"
    assert out[1] is None


from hypothesis import Phase, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_pt = st.tuples(st.integers(-20, 20), st.integers(-20, 20)).map(lambda p: [p[0] / 4.0, p[1] / 4.0])


def _crosses(a, b):
    def o(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    return o(a[0], a[1], b[0]) * o(a[0], a[1], b[1]) < 0 and o(b[0], b[1], a[0]) * o(b[0], b[1], a[1]) < 0


def _conflict(a, b, neighbours):
    """Plain form of the rule: cross, overlap along a line, or touch without being neighbours."""

    def o(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    def on(e, p):
        return o(*e, p) == 0 and all(min(e[0][i], e[1][i]) <= p[i] <= max(e[0][i], e[1][i]) for i in (0, 1))

    if _crosses(a, b):
        return True
    if o(*a, b[0]) == 0 and o(*a, b[1]) == 0:
        if any(min(max(a[0][i], a[1][i]), max(b[0][i], b[1][i])) > max(min(a[0][i], a[1][i]), min(b[0][i], b[1][i])) for i in (0, 1)):
            return True
    return not neighbours and (on(a, b[0]) or on(a, b[1]) or on(b, a[0]) or on(b, a[1]))


@settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.lists(_pt, min_size=3, max_size=9), min_size=1, max_size=6))
def test_grid_conflicts_equal_all_pairs(spark, rings):
    data = [(i, [[ring + [ring[0]]]]) for i, ring in enumerate(rings)]
    regions = _regions(spark, data)
    got = {r.hot_project: r.is_valid for r in assign.region_valid(regions).collect()}
    for i, ring in enumerate(rings):
        closed = ring + [ring[0]]
        edges = [e for e in zip(closed, closed[1:]) if e[0] != e[1]]
        n = len(edges)
        bad = any(_conflict(edges[a], edges[b], b - a in (1, n - 1)) for a in range(n) for b in range(a + 1, n))
        assert got[i] == (not bad), (i, ring)
