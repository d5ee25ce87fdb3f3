"""Cell index of regions, adaptive cells of edges, interiors in one piece, heavy users in the shuffled join."""

import contextlib
import io
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from cartoledger.functions import geo
from cartoledger.operators import assign, joins, regioncells

GEOM = "hot_project int, geom array<array<array<array<double>>>>"
BOXES = "changeset int, hot_project int, min_lat double, max_lat double, min_lon double, max_lon double"


def _ring(rng, cx, cy, r, n, snap):
    pts = []
    for i in range(n):
        q, a = r * (0.4 + 0.6 * rng.random()), 2 * math.pi * i / n
        x, y = cx + q * math.cos(a), cy + q * math.sin(a)
        pts.append([round(x * 4) / 4, round(y * 4) / 4] if snap else [x, y])
    return [*pts, pts[0]]


def _case(seed):
    """Rings with holes, some on a coarse lattice, overlapping parts; boxes of all sizes, flat ones and points."""
    rng = random.Random(seed)
    regions, boxes = [(0, [[[[0.0, 0.0], [8.0, 0.0], [8.0, 8.0], [0.0, 0.0]]]])], []
    for p in range(1, 16):
        parts = []
        for q in range(rng.choice([1, 1, 2, 3])):
            cx = q * 15.0 * (1 if p % 3 else 0.3)
            shell = _ring(rng, cx, 0.0, 10, rng.choice([3, 4, 8, 40, 250]), p % 2)
            hole = _ring(rng, cx, 0.0, 3, rng.choice([3, 4, 30]), p % 2)
            parts.append([shell, hole] if rng.random() < 0.6 else [shell])
        regions.append((p, parts))
    for k in range(1800):
        size = 10 ** rng.uniform(-2, 1.5)
        v = [rng.uniform(-14, 40), rng.uniform(-14, 14), size * rng.random(), size * rng.random()]
        if k % 5 == 0:
            v = [round(x * 4) / 4 for x in v]
        if k % 7 == 0:
            v[k % 3 + 1 if k % 3 else 2] = 0.0
        x, y, w, h = v
        boxes.append((k, k % 16, y, y + h, x, x + w))
    return regions, boxes


@pytest.mark.parametrize("seed", [1, 2])
def test_cell_index_equals_direct_test(spark, seed):
    regions, boxes = _case(seed)
    edges = assign.region_edges(spark.createDataFrame(regions, GEOM))
    boxes = spark.createDataFrame(boxes, BOXES)
    direct = geo.region_meets_box("edges", "min_lon", "min_lat", "max_lon", "max_lat")
    want = sorted(r.changeset for r in boxes.join(edges, "hot_project").where(direct).select("changeset").collect())
    cand = boxes.join(edges.select("hot_project", *assign.EXTENT), "hot_project").where(assign._box_meets_extent())
    got = assign._by_cells(cand, regioncells.region_cells(edges))
    assert sorted(r.changeset for r in got.select("changeset").collect()) == want and len(want) > 200
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain()
    assert "CartesianProduct" not in buf.getvalue() and "BroadcastNestedLoopJoin" not in buf.getvalue()


def test_small_boxes_see_few_edges(spark):
    """A box of a hundredth of the region's width is held against 2 % of its 4,000 edges on average."""
    rng = random.Random(3)
    region = spark.createDataFrame([(1, [[_ring(rng, 0.0, 0.0, 10, 4000, False)]])], GEOM)
    edges = assign.region_edges(region)
    cells = regioncells.region_cells(edges)
    boxes = [(k, 1, y, y + 0.2, x, x + 0.2) for k in range(300) for x, y in [(rng.uniform(-9, 9), rng.uniform(-9, 9))]]
    cand = spark.createDataFrame(boxes, BOXES).join(edges.select("hot_project", *assign.EXTENT), "hot_project")
    sizes = [r.n for r in regioncells.clipped(cand).join(cells, regioncells.KEY).select(F.size("edges").alias("n")).collect()]
    assert statistics.mean(sizes) < 80 and max(sizes) < 800


def test_dense_coast_and_a_far_point_give_few_rows(spark):
    """Rows of the conflict test grow with the edges, not with the square of those that crowd together."""
    rng = random.Random(4)

    def coast(n):
        x, pts = 0.0, []
        for _ in range(n):
            x += 1e-4
            pts.append([x, 1e-4 * rng.random()])
        return [[[*pts, [90.0, 60.0], [0.0, 60.0], pts[0]]]]

    rows = {}
    for n in (500, 4000):
        cells = assign._leaf_cells(assign._features(spark.createDataFrame([(1, coast(n))], GEOM)))
        per_cell = cells.groupBy("_f", "level", "cx", "cy").count().agg(F.max("count"), F.sum("count")).first()
        assert per_cell[0] <= assign.CELL_EDGES
        rows[n] = per_cell[1]
    assert rows[500] < 5 * 500 and rows[4000] < 5 * 4000
    assert assign.region_valid(spark.createDataFrame([(1, coast(500))], GEOM)).first().is_valid
    crossed = coast(500)
    crossed[0][0][200][1] = 59.0  # a spike through nothing: still simple
    crossed[0][0][300] = [0.0150, 30.0]  # leans across the spike
    assert not assign.region_valid(spark.createDataFrame([(1, crossed)], GEOM)).first().is_valid


def _plain_conflict(ring):
    edges = [e for e in zip(ring, ring[1:]) if e[0] != e[1]]

    def o(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    def meet(a, b):
        if max(a[0][0], a[1][0]) < min(b[0][0], b[1][0]) or max(b[0][0], b[1][0]) < min(a[0][0], a[1][0]):
            return False
        if max(a[0][1], a[1][1]) < min(b[0][1], b[1][1]) or max(b[0][1], b[1][1]) < min(a[0][1], a[1][1]):
            return False
        return o(*a, b[0]) * o(*a, b[1]) <= 0 and o(*b, a[0]) * o(*b, a[1]) <= 0

    n = len(edges)
    return any(meet(edges[i], edges[j]) for i in range(n) for j in range(i + 2, n) if (i, j) != (0, n - 1))


def test_split_cells_find_all_conflicts(spark):
    """Rings with several hundred edges, some crossing themselves far apart, against all pairs."""
    rng = random.Random(6)
    regions = []
    for p in range(12):
        ring = _ring(rng, 0.0, 0.0, 10, 240, False)
        if p % 2:
            i, j = rng.randrange(5, 110), rng.randrange(120, 230)
            ring[i] = [ring[j][0] * 1.01, ring[j][1] * 1.01] if p % 4 == 1 else ring[j][:]
        regions.append((p, [[ring]]))
    got = {r.hot_project: r.is_valid for r in assign.region_valid(spark.createDataFrame(regions, GEOM)).collect()}
    assert got == {p: not _plain_conflict(g[0][0]) for p, g in regions}
    assert set(got.values()) == {True, False}


def _diamond(x, y, r):
    return [[x - r, y], [x, y - r], [x + r, y], [x, y + r], [x - r, y]]


def test_interior_in_one_piece(spark):
    """Touching rings cut the interior exactly where they close a circle."""
    big = [[0.0, 0.0], [12.0, 0.0], [12.0, 12.0], [0.0, 12.0], [0.0, 0.0]]
    chain = [_diamond(2.0 + 2 * i, 6.0, 1.0) for i in range(5)]  # touch each other at (3,6), (5,6), ...
    circle = [_diamond(x, y, 1.0) for x, y in ((4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0))]
    apart = [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]]
    regions = [
        (1, [[big, apart]]),
        (2, [[big, _diamond(1.0, 6.0, 1.0)]]),  # touches the shell once
        (3, [[big, *chain]]),  # a chain inside, ends free
        (4, [[big, _diamond(1.0, 6.0, 1.0), *[_diamond(3.0 + 2 * i, 6.0, 1.0) for i in range(5)]]]),  # from side to side
        (5, [[big, _diamond(6.0, 6.0, 6.0)]]),  # one hole touches all four sides
        (6, [[big, _diamond(1.0, 6.0, 1.0), *[_diamond(3.0 + 2 * i, 6.0, 1.0) for i in range(4)]]]),  # stops short
        (7, [[big], [[[12.0, 0.0], [14.0, 0.0], [12.0, -2.0], [12.0, 0.0]]]]),  # parts that touch
        (8, [[big, *circle]]),  # four holes round a piece of their own
        (9, [[big, *circle[:3]]]),
    ]
    got = {r.hot_project: r.is_valid for r in assign.region_valid(spark.createDataFrame(regions, GEOM)).collect()}
    assert {p for p, ok in got.items() if not ok} == {4, 5, 8}
    kept = {r.hot_project for r in assign.usable_regions(spark.createDataFrame(regions, GEOM)).collect()}
    assert kept == {1, 2, 3, 6, 7, 9}


def test_heavy_user_is_dealt_to_several_tasks(spark):
    """Half of the rows belong to one user: the shuffled join gives every task about the same."""
    n = 40_000
    big = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise((F.col("id") % 5000).cast("int") + 100).cast("int").alias("uid"),
        F.col("id").alias("changeset"),
    )
    small = spark.range(5200).select(F.col("id").cast("int").alias("uid"), (F.col("id") * 2).alias("p"))
    a, b = joins.spread(big, small, "uid")
    keys = ["spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "false")
        spark.conf.set(keys[1], "8")
        out = a.join(b, ["uid", "_salt"]).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("task").count().collect()]
        assert sum(sizes) == n and len(sizes) == 8
        assert max(sizes) <= 2 * statistics.median(sizes)
        assert out.select("changeset").distinct().count() == n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    plain = [joins.spread(d, small, "uid") for d in (big.where("uid <> 7").limit(0), spark.range(0).selectExpr("int(id) uid"))]
    assert all(x.join(y, ["uid", "_salt"]).count() == 0 for x, y in plain)
