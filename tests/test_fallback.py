"""Beyond the broadcast bounds the joins shuffle instead, with the same results."""

import contextlib
import io
import os

import pytest

from conftest import rows

from cartoledger.operators import joins
from cartoledger.plans.pipeline import Inputs, Pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_shuffle_path_equals_broadcast_path(spark, monkeypatch):
    p = Pipeline(Inputs.from_testdata(spark, SF))
    expected = rows(p.assigned.select("changeset", "hot_project"))
    expected_prior = rows(p.prior_experience)
    monkeypatch.setattr(joins, "DEFAULT_MAX_ROWS", 0)
    monkeypatch.setattr(joins, "DEFAULT_MAX_ELEMENTS", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = Pipeline(Inputs.from_testdata(spark, SF))
        got = q.assigned.select("changeset", "hot_project")
        got_prior = q.prior_experience
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            got_prior.explain()
        plan = buf.getvalue()
        assert "BroadcastHashJoin" not in plan
        assert rows(got) == expected
        assert rows(got_prior) == expected_prior
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
