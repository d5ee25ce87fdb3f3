"""Section 2.11: the SQL functions equal the Column helpers."""

import random

import pytest

from cartoledger.functions import geo
from cartoledger.functions import sql as sqlfn


def test_sql_functions_equal_column_helpers(spark):
    sqlfn.register(spark)
    rnd = random.Random(3)
    data = [(None, None, None, None), (0.0, 1.0, 0.0, 1.0), (-0.00005, 0.2, 1.0, 1.1), (5.0, 5.0, 1.0, 2.0)]
    for _ in range(200):
        a, b = sorted(rnd.uniform(-80, 80) for _ in range(2))
        c, d = sorted(rnd.uniform(-170, 170) for _ in range(2))
        data.append((a, b, c, d))
    for _ in range(50):
        a, c = rnd.uniform(-80, 80), rnd.uniform(-170, 170)
        data.append((a, a + rnd.random(), c, c + rnd.random()))
    df = spark.createDataFrame(data, "min_lat double, max_lat double, min_lon double, max_lon double")
    df.createOrReplaceTempView("boxes")
    via_sql = spark.sql(
        "SELECT bbox_geog_area(min_lat, max_lat, min_lon, max_lon) AS a, make_bbox(min_lat, max_lat, min_lon, max_lon) AS w FROM boxes"
    ).collect()
    via_col = df.select(
        geo.bbox_area_m2("min_lat", "max_lat", "min_lon", "max_lon").alias("a"),
        geo.bbox_wkt("min_lat", "max_lat", "min_lon", "max_lon").alias("w"),
    ).collect()
    assert [r.w for r in via_sql] == [r.w for r in via_col]
    assert [r.a for r in via_sql] == [r.a if r.a is None else pytest.approx(r.a, rel=1e-12) for r in via_col]
    world = spark.sql("SELECT get_world_bbox() AS w").first().w
    assert world == "POLYGON((-180.0000000 -90.0000000,180.0000000 -90.0000000,180.0000000 90.0000000,-180.0000000 90.0000000,-180.0000000 -90.0000000))"
