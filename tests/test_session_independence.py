"""Results do not depend on the caller's session settings (the driver owns its session)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

KEYS = ["changeset_rollup", "changeset_bbox_area", "session_gaps", "session_labour", "first_contribution",
        "prior_experience", "stats_monthly"]


def test_other_zone_types_and_ansi(spark):
    from compare_oracle import digest, duck

    from __spark_entry__ import oracle_sql, queries

    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    other.conf.set("spark.sql.timestampType", "TIMESTAMP_LTZ")
    other.conf.set("spark.sql.ansi.enabled", "false")
    other.conf.set("spark.sql.shuffle.partitions", "3")
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    con = duck(SF)
    for key in KEYS:
        df = queries()[key](other, SF)
        res = con.sql(oracle_sql()[key])
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(res.columns, res.fetchall())[0], key
