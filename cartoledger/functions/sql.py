"""The reference's three scalar functions as SQL functions (section 2.11).

``register(spark)`` creates temporary SQL functions so the helpers can be used
in SQL text; Spark inlines their bodies, so they run inside whole-stage codegen
like the Column helpers in ``geo``. The formulas and constants are the same as
there (tests check equality).

    make_bbox(min_lat, max_lat, min_lon, max_lon)       -> STRING (WKT polygon, NULL without coordinates)
    bbox_geog_area(min_lat, max_lat, min_lon, max_lon)  -> DOUBLE (m2)
    get_world_bbox()                                    -> STRING (WKT polygon of the world)
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

from . import geo


def _d(x: float) -> str:
    return f"{x!r}D"


_E = math.sqrt(geo.WGS84_E2)


def _q_of_sine(s: str) -> str:
    return (
        f"{s} / (1.0D - {_d(geo.WGS84_E2)} * {s} * {s}) + "
        f"ln((1.0D + {_d(_E)} * {s}) / (1.0D - {_d(_E)} * {s})) / {_d(2.0 * _E)}"
    )


def _over_nodes(circle: str, value) -> str:
    """The sum over the Gauss nodes of ``value`` at the tangent of the reduced latitude there."""
    nodes = ", ".join(f"named_struct('x', {_d(x)}, 'w', {_d(w)})" for x, w in geo.half_side_nodes())
    tan_low = f"{_d(math.sqrt(1.0 - geo.WGS84_E2))} * tan(radians(lat))"
    at = f"({tan_low} / cos({circle}) * cos({circle} * n.x))"
    return f"aggregate(array({nodes}), 0.0D, (total, n) -> total + n.w * {value(at)})"


def _under_geodesic() -> str:
    flat, b2 = _d(math.sqrt(1.0 - geo.WGS84_E2)), _d(geo.WGS84_B**2)

    def rate(t: str) -> str:
        return f"sqrt(1.0D - {_d(geo.WGS84_E2)} / (1.0D + {t} * {t}))"

    def below(t: str) -> str:
        below_one = f"({t} / {flat})"
        return f"({_q_of_sine(f'({below_one} / sqrt(1.0D + {below_one} * {below_one}))')}) * {rate(t)}"

    steps = ", ".join("0" for _ in range(geo.CIRCLE_STEPS))
    half = "(width / 2.0D)"
    circle = f"aggregate(array({steps}), {half}, (c, i) -> {half} / {_over_nodes('c', rate)})"
    return (
        f"CASE WHEN width >= {_d(math.radians(geo.WIDEST_LON))} OR abs(lat) >= 89.999999D "
        f"THEN {b2} * {half} * cartoledger_authalic_q(lat) "
        f"ELSE transform(array({circle}), c -> {b2} * c * {_over_nodes('c', below)})[0] END"
    )


def _bodies() -> list[str]:
    band = (
        f"CASE WHEN lat1 >= lat2 THEN 0.0D WHEN lon1 >= lon2 THEN 0.0D "
        f"ELSE {_d(geo.WGS84_B * geo.WGS84_B)} * radians(lon2 - lon1) / 2.0D * "
        f"(cartoledger_authalic_q(lat2) - cartoledger_authalic_q(lat1)) END"
    )
    s = "sin(radians(lat))"
    bulge = (
        f"{_d(geo.WGS84_B**2 / (1.0 - geo.WGS84_E2))} / (1.0D - {_d(geo.WGS84_E2)} * {s} * {s}) * "
        f"(2.0D * atan({s} * tan(width / 2.0D)) - width * {s})"
    )
    narrow = (
        "CASE WHEN lat1 >= lat2 OR lon1 >= lon2 THEN 0.0D ELSE cartoledger_band_area(lat1, lat2, lon1, lon2) "
        "+ cartoledger_bulge(lat2, radians(lon2 - lon1)) - cartoledger_bulge(lat1, radians(lon2 - lon1)) END"
    )
    gap = _d(geo.EQUATOR_GAP_LAT)

    def under(lat: str) -> str:
        return f"cartoledger_under_geodesic({lat}, radians(max_lon - min_lon))"

    wide = (
        "CASE WHEN min_lat <= 0.0D AND max_lat >= 0.0D THEN "
        f"CASE WHEN min_lat < -{gap} THEN -{under(gap)} - {under('min_lat')} ELSE 0.0D END + "
        f"CASE WHEN max_lat > {gap} THEN {under('max_lat')} - {under(gap)} ELSE 0.0D END "
        f"ELSE {under('max_lat')} - {under('min_lat')} END"
    )
    area = (
        "CASE WHEN min_lat >= max_lat THEN 0.0D WHEN min_lon >= max_lon THEN 0.0D "
        f"WHEN max_lon - min_lon > {_d(geo.NARROW_LON)} THEN {wide} "
        "WHEN min_lat <= 0.0D AND max_lat >= 0.0D THEN "
        f"cartoledger_narrow_area(min_lat, -{gap}, min_lon, max_lon) + cartoledger_narrow_area({gap}, max_lat, min_lon, max_lon) "
        "ELSE cartoledger_narrow_area(min_lat, max_lat, min_lon, max_lon) END"
    )
    pt = "%.7f %.7f"
    wkt = "'POLYGON((" + ",".join([pt] * 5) + "))'"
    bbox = (
        f"CASE WHEN min_lat IS NOT NULL THEN format_string({wkt}, min_lon, min_lat, max_lon, min_lat, "
        "max_lon, max_lat, min_lon, max_lat, min_lon, min_lat) END"
    )
    w_min_lat, w_max_lat, w_min_lon, w_max_lon = geo.WORLD_BOX
    box4 = "min_lat DOUBLE, max_lat DOUBLE, min_lon DOUBLE, max_lon DOUBLE"
    return [
        f"CREATE OR REPLACE TEMPORARY FUNCTION cartoledger_authalic_q(lat DOUBLE) RETURNS DOUBLE RETURN {_q_of_sine(s)}",
        "CREATE OR REPLACE TEMPORARY FUNCTION cartoledger_band_area(lat1 DOUBLE, lat2 DOUBLE, lon1 DOUBLE, lon2 DOUBLE) "
        f"RETURNS DOUBLE RETURN {band}",
        f"CREATE OR REPLACE TEMPORARY FUNCTION cartoledger_bulge(lat DOUBLE, width DOUBLE) RETURNS DOUBLE RETURN {bulge}",
        "CREATE OR REPLACE TEMPORARY FUNCTION cartoledger_narrow_area(lat1 DOUBLE, lat2 DOUBLE, lon1 DOUBLE, lon2 DOUBLE) "
        f"RETURNS DOUBLE RETURN {narrow}",
        "CREATE OR REPLACE TEMPORARY FUNCTION cartoledger_under_geodesic(lat DOUBLE, width DOUBLE) "
        f"RETURNS DOUBLE RETURN {_under_geodesic()}",
        f"CREATE OR REPLACE TEMPORARY FUNCTION bbox_geog_area({box4}) RETURNS DOUBLE RETURN {area}",
        f"CREATE OR REPLACE TEMPORARY FUNCTION make_bbox({box4}) RETURNS STRING RETURN {bbox}",
        "CREATE OR REPLACE TEMPORARY FUNCTION get_world_bbox() RETURNS STRING "
        f"RETURN make_bbox({_d(w_min_lat)}, {_d(w_max_lat)}, {_d(w_min_lon)}, {_d(w_max_lon)})",
    ]


def register(spark: SparkSession) -> None:
    """Create the temporary SQL functions in ``spark``'s session."""
    for stmt in _bodies():
        spark.sql(stmt)
