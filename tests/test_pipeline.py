"""The ordered run writes every derived table; stage() writes under spark.checkpoint.dir."""

import os

import pytest

from conftest import rows

from cartoledger.plans.pipeline import ConstraintError, Inputs, Pipeline, run
from cartoledger.session import stage

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_run_writes_all_tables(spark, tmp_path):
    paths = run(Inputs.from_testdata(spark, SF), str(tmp_path))
    expected = {
        "hot_project_registered_contributor", "hot_project_contributor", "hot_project_changeset_tag", "changeset",
        "changeset_assigned", "changeset_hot_project", "changeset_editor", "changeset_comment", "user_hmp_session_rows",
        "user_hmp_session_changeset", "user_hmp_session", "user_first_hot_contribution", "user_prior_experience",
        "user_hot_contributions", "changeset_meta", "changeset_meta_tags", "uid_list", "way_ids", "way_id_list",
        "way_deletions", "project_areas", "project_region_cells", "user_hmp_session_size",
        *(f"{k}_edit_history" for k in ("node", "way", "rel")), *(f"{k}_tag_edit_history" for k in ("node", "way", "rel")),
    }
    assert set(paths) == expected
    stored = spark.read.parquet(paths["user_hmp_session"])
    lazy = Pipeline(Inputs.from_testdata(spark, SF), staged=False).session
    cols = ["uid", "hot_project", "session", "num_edits"]
    assert rows(stored.select(*cols)) == rows(lazy.select(*cols))
    assert stored.count() == 281
    assert "bbox" in spark.read.parquet(paths["changeset"]).columns
    assert spark.read.parquet(paths["way_deletions"]).count() > 0


def test_run_stops_on_a_violation(spark, tmp_path):
    i = Inputs.from_testdata(spark, SF)
    i._df["activity"] = i.activity.union(i.activity)
    with pytest.raises(ConstraintError, match="activity"):
        run(i, str(tmp_path))


def test_contributors_and_uids_from_the_dumps(spark):
    """Without their own files, H1 and S4 feed J1 and J2."""
    full = Inputs.from_testdata(spark, SF)
    kept = {k: v for k, v in full._src.items() if k not in ("uid_username", "history_contributor")}
    i = Inputs(spark, **kept)
    assert i.uid_username.columns == ["uid", "username"] and i.uid_username.count() > 0
    assert i.history_contributor.columns == full.history_contributor.columns and i.history_contributor.count() > 0


def test_checks_are_empty_on_fixture(spark):
    p = Pipeline(Inputs.from_testdata(spark, SF))
    for name, df in p.checks().items():
        assert df.count() == 0, name


def test_stage_under_checkpoint_dir(spark):
    df = spark.createDataFrame([(1,)], "k int")
    back = stage(df, "probe")
    root = spark.conf.get("spark.checkpoint.dir")
    assert any(root.rstrip("/").replace("file:", "") in f.replace("file:", "") for f in back.inputFiles())


def test_stage_with_metrics_and_known_bound(spark):
    from pyspark.sql import functions as F

    from cartoledger.operators import joins
    from cartoledger.session import stage_with_metrics

    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0])], "k int, xs array<double>")
    back, m = stage_with_metrics(df, "probe_metrics", [F.count(F.lit(1)).alias("rows"), F.sum(F.size("xs")).alias("n")])
    assert m == {"rows": 2, "n": 3}
    assert sorted(r.k for r in back.collect()) == [1, 2]
    small = joins.bounded_broadcast_by(back, F.size("xs"), max_total=3, known_total=m["n"])
    big = joins.bounded_broadcast_by(back, F.size("xs"), max_total=2, known_total=m["n"])
    joined_small = spark.range(3).join(small, F.col("id") == F.col("k"))
    joined_big = spark.range(3).join(big, F.col("id") == F.col("k"))
    assert sorted(r.k for r in joined_small.collect()) == sorted(r.k for r in joined_big.collect()) == [1, 2]
