"""Box areas with geodesic sides, against integration along the geodesic's differential equation."""

import math

import pytest

from cartoledger.functions import geo

A, F_ = 6378137.0, 1 / 298.257223563
E2 = F_ * (2 - F_)


def _radii(lat):
    k = 1 - E2 * math.sin(lat) ** 2
    return A * (1 - E2) / k**1.5, A / math.sqrt(k)


def _below(lat, n=4000):
    """Area per radian of longitude between the equator and a latitude: Simpson's rule over M N cos."""
    h = lat / n

    def f(x):
        m, r = _radii(x)
        return m * r * math.cos(x)

    return h / 3 * (f(0) + f(lat) + 4 * sum(f((2 * i + 1) * h) for i in range(n // 2)) + 2 * sum(f(2 * i * h) for i in range(1, n // 2)))


def _walk(top, half, steps=600):
    """From the top of a geodesic (heading east) to ``half`` radians of longitude: latitude there and area below."""
    lat, lon, az, area = top, 0.0, math.pi / 2, 0.0
    q0, m0 = _below(top), 0.0

    def slope(lat, az):
        m, r = _radii(lat)
        d = math.sin(az) / (r * math.cos(lat))
        return math.cos(az) / m, d, math.tan(lat) * math.sin(az) / r

    def q(lat):
        """The area below a latitude: that of the top and the way down by Simpson's rule."""
        h = (lat - top) / 8

        def f(x):
            m, r = _radii(x)
            return m * r * math.cos(x)

        return q0 + h / 3 * (f(top) + 4 * f(top + h) + 2 * f(top + 2 * h) + 4 * f(top + 3 * h) + 2 * f(top + 4 * h)
                             + 4 * f(top + 5 * h) + 2 * f(top + 6 * h) + 4 * f(top + 7 * h) + f(lat))

    h = half / steps
    for _ in range(steps):
        # Runge-Kutta over longitude
        def d(lat, az):
            a, b, c = slope(lat, az)
            return a / b, c / b

        k1 = d(lat, az)
        k2 = d(lat + h / 2 * k1[0], az + h / 2 * k1[1])
        k3 = d(lat + h / 2 * k2[0], az + h / 2 * k2[1])
        k4 = d(lat + h * k3[0], az + h * k3[1])
        mid = lat + h / 4 * (k1[0] + k2[0])
        new = lat + h / 6 * (k1[0] + 2 * k2[0] + 2 * k3[0] + k4[0])
        az += h / 6 * (k1[1] + 2 * k2[1] + 2 * k3[1] + k4[1])
        area += h / 6 * (q(lat) + 4 * q(mid) + q(new))
        lat = new
    return lat, area


def _under(lat, width):
    """Area below the geodesic between two points of latitude ``lat`` (radians), its top found by bisection."""
    if lat < 0:
        return -_under(-lat, width)
    low, high = lat, min(math.pi / 2 - 1e-6, math.atan(math.tan(lat) / math.cos(width / 2)) + 0.01)
    for _ in range(45):
        top = (low + high) / 2
        if _walk(top, width / 2, 60)[0] < lat:
            low = top
        else:
            high = top
    # one secant step with fine walks
    a, b = top - 1e-6, top + 1e-6
    la, lb = _walk(a, width / 2)[0], _walk(b, width / 2)[0]
    top = a + (lat - la) * (b - a) / (lb - la)
    return 2 * _walk(top, width / 2)[1]


CASES = [
    (10.0, 11.0, 0.0, 1.0), (50.0, 50.1, 0.0, 1.9), (50.0, 50.1, 0.0, 2.1), (60.0, 61.0, 5.0, 25.0), (-35.0, -34.5, 0.0, 60.0),
    (45.0, 45.2, -60.0, 60.0), (70.0, 75.0, 0.0, 3.0),
]


@pytest.mark.parametrize("box", CASES)
def test_area_equals_integration(spark, box):
    df = spark.createDataFrame([box], "a double, b double, c double, d double")
    got = df.select(geo.bbox_area_m2("a", "b", "c", "d").alias("x")).first().x
    width = math.radians(box[3] - box[2])
    want = _under(math.radians(box[1]), width) - _under(math.radians(box[0]), width)
    assert got == pytest.approx(want, rel=1e-6)


def test_flat_wide_boxes_follow_geodesics(spark):
    """The sides of a flat wide box bend towards the pole alike; near the limit of 100 km2 this decides."""
    df = spark.createDataFrame([(60.0, 60.001, 0.0, 16.0)], "a double, b double, c double, d double")
    r = df.select(geo.bbox_area_m2("a", "b", "c", "d").alias("x"), geo._band_area(df.a, df.b, df.c, df.d).alias("p")).first()
    assert r.p < geo.MAX_BOX_AREA_M2 and abs(r.x - r.p) / r.p > 1e-3


def test_forms_agree_where_they_meet(spark):
    rows = [(lat, lat + 0.5, 0.0, geo.NARROW_LON + d) for lat in (-80.0, -20.0, -0.2, 0.0, 3.0, 45.0, 85.0) for d in (-1e-9, 1e-9)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r.x for r in df.select(geo.bbox_area_m2("a", "b", "c", "d").alias("x")).collect()]
    for narrow, wide in zip(got[::2], got[1::2]):
        assert narrow == pytest.approx(wide, rel=1e-8)
    whole = spark.createDataFrame([(-90.0, 90.0, -180.0, 180.0), (-1.0, 1.0, 0.0, 30.0), (-1.0, -0.5, 0.0, 30.0), (0.5, 1.0, 0.0, 30.0)], "a double, b double, c double, d double")
    x = [r.x for r in whole.select(geo.bbox_area_m2("a", "b", "c", "d").alias("x")).collect()]
    assert x[0] == pytest.approx(5.10065621724e14, rel=1e-5) and x[2] == pytest.approx(x[3], rel=1e-12)
