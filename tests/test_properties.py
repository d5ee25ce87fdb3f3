"""Properties on the sf0.001 fixture and on generated boxes."""

import datetime as dt
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartoledger.functions import geo
from cartoledger.plans.pipeline import Inputs, Pipeline

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def pipe(spark):
    return Pipeline(Inputs.from_testdata(spark, SF))


@needs_data
def test_rollup_keeps_every_edit(pipe):
    edits = sum(df.count() for df in (pipe.i.node_edits, pipe.i.way_edits, pipe.i.rel_edits))
    rolled = pipe.changeset.groupBy().sum("num_edits").first()[0]
    assert rolled == edits


@needs_data
def test_sessions_dense_contained_and_separated(pipe):
    rows = pipe.session_rows.select("uid", "hot_project", "session", "changeset", "first_date", "last_date").collect()
    sessions = pipe.session.collect()
    ids = sorted(s.session for s in sessions)
    assert ids == list(range(1, len(ids) + 1))
    span = {s.session: (s.first_date, s.last_date) for s in sessions}
    for r in rows:
        lo, hi = span[r.session]
        assert lo <= r.first_date and r.last_date <= hi
    by_group = {}
    for r in sorted(rows, key=lambda r: (r.uid, r.hot_project, r.first_date, r.changeset)):
        by_group.setdefault((r.uid, r.hot_project), []).append(r)
    for seq in by_group.values():
        for prev, cur in zip(seq, seq[1:]):
            gap = cur.first_date - prev.last_date
            if cur.session != prev.session:
                assert gap > dt.timedelta(hours=1)
            else:
                assert gap <= dt.timedelta(hours=1)


@needs_data
def test_area_never_negative(pipe):
    a = pipe.changeset.select(geo.bbox_area_m2("min_lat", "max_lat", "min_lon", "max_lon").alias("a"))
    assert a.where("a < 0").count() == 0


lat = st.floats(min_value=-89.0, max_value=89.0, allow_nan=False)
lon = st.floats(min_value=-179.0, max_value=179.0, allow_nan=False)


@settings(max_examples=25, deadline=None)
@given(lat, lat, lon, lon, st.floats(min_value=0.01, max_value=0.99))
def test_area_additive_in_longitude(spark, a, b, c, d, frac):
    lo, hi = sorted((a, b))
    w, e = sorted((c, d))
    mid = w + (e - w) * frac
    df = spark.createDataFrame([(lo, hi, w, e, mid)], "lo double, hi double, w double, e double, m double")
    whole = geo.bbox_area_m2("lo", "hi", "w", "e")
    parts = geo.bbox_area_m2("lo", "hi", "w", "m") + geo.bbox_area_m2("lo", "hi", "m", "e")
    r = df.select(whole.alias("x"), parts.alias("y")).first()
    assert r.x >= 0 and r.x == pytest.approx(r.y, rel=1e-9, abs=1e-3)
