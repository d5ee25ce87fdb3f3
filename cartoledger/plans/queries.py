"""Registered queries: one per operator key of the survey, each ``(spark, sf_dir) -> DataFrame``.

Each query derives its inputs from the driver's tables through the adapter
and runs the library operator over the whole tables. Output columns match the
DuckDB oracle in ``oracle.py`` by name and type. Floating results that are
sums or means are rounded to 6 significant digits; intervals are given as
whole microseconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rounding import round_sig
from ..functions.timeops import interval_micros
from ..operators import assign, changesets, checks, contributions, contributors, history, sessions, stats
from ..sources import adapter
from .pipeline import Inputs, Pipeline

Query = Callable[[SparkSession, str], DataFrame]


def _p(spark: SparkSession, sf_dir: str) -> Pipeline:
    # Shared intermediate tables are stored under spark.checkpoint.dir.
    return Pipeline(Inputs.from_testdata(spark, sf_dir))


def uid_username_map(spark, sf_dir):
    return history.uid_username(adapter.history(spark, sf_dir))


def user_edit_history(spark, sf_dir):
    return _p(spark, sf_dir).user_edits("node")


def user_tag_edit_history(spark, sf_dir):
    return _p(spark, sf_dir).user_tag_edits("node")


def user_edit_history_way(spark, sf_dir):
    return _p(spark, sf_dir).user_edits("way")


def user_edit_history_rel(spark, sf_dir):
    return _p(spark, sf_dir).user_edits("rel")


def user_tag_edit_history_way(spark, sf_dir):
    return _p(spark, sf_dir).user_tag_edits("way")


def user_tag_edit_history_rel(spark, sf_dir):
    return _p(spark, sf_dir).user_tag_edits("rel")


def way_deletion_history(spark, sf_dir):
    return _p(spark, sf_dir).way_deletions()


def tagged_contributors(spark, sf_dir):
    return contributors.tagged_contributors(adapter.changeset_meta(spark, sf_dir), adapter.changeset_meta_tags(spark, sf_dir))


def contributor_registered(spark, sf_dir):
    return _p(spark, sf_dir).registered


def contributor_combined(spark, sf_dir):
    return _p(spark, sf_dir).contributor


def contributor_uid_list(spark, sf_dir):
    return _p(spark, sf_dir).uid_list


def contributor_match_rate(spark, sf_dir):
    return contributors.match_rate(_p(spark, sf_dir).registered)


def way_id_list(spark, sf_dir):
    return changesets.way_id_list(adapter.way_edits(spark, sf_dir))


def project_changeset_tag(spark, sf_dir):
    return changesets.project_tags(adapter.project_description(spark, sf_dir))


def changeset_summary_node(spark, sf_dir):
    return changesets.summary_node(adapter.node_edits(spark, sf_dir))


def changeset_summary_way(spark, sf_dir):
    return changesets.summary_way(adapter.way_edits(spark, sf_dir))


def changeset_summary_rel(spark, sf_dir):
    return changesets.summary_rel(adapter.rel_edits(spark, sf_dir))


def changeset_rollup(spark, sf_dir):
    return _p(spark, sf_dir).changeset


def changeset_bbox_wkt(spark, sf_dir):
    return changesets.with_bbox(_p(spark, sf_dir).changeset)


def changeset_bbox_area(spark, sf_dir):
    a = changesets.with_area(_p(spark, sf_dir).changeset)
    return a.select("changeset", round_sig("area_m2").alias("area_m2"))


def changeset_small_area(spark, sf_dir):
    return changesets.small_area(_p(spark, sf_dir).changeset)


def region_valid(spark, sf_dir):
    return assign.region_valid(adapter.project_region(spark, sf_dir))


def region_in_world(spark, sf_dir):
    return assign.region_in_world(adapter.project_region(spark, sf_dir))


def region_meets_box(spark, sf_dir):
    p = _p(spark, sf_dir)
    return assign.meets_box(p.i.region, p.changeset, p.contributor)


def changeset_in_period(spark, sf_dir):
    p = _p(spark, sf_dir)
    return assign.in_period(p.changeset, p.contributor, p.i.activity)


def changeset_project(spark, sf_dir):
    return _p(spark, sf_dir).changeset_project


def changeset_assigned(spark, sf_dir):
    return _p(spark, sf_dir).assigned


def changeset_editor(spark, sf_dir):
    return _p(spark, sf_dir).editor


def changeset_comment(spark, sf_dir):
    return _p(spark, sf_dir).comment


def session_gaps(spark, sf_dir):
    g = _p(spark, sf_dir).session_rows
    return g.select(
        "uid", "hot_project", "changeset", "first_date", "last_date",
        interval_micros("time_since_prev_cs").alias("time_since_prev_us"),
    )


def session_assign(spark, sf_dir):
    return _p(spark, sf_dir).session_rows.select("uid", "hot_project", "session", "changeset")


def _size_out(df: DataFrame) -> DataFrame:
    return df.select(
        "uid", "hot_project", "session", "first_date", "last_date", round_sig("labour_hours").alias("labour_hours"),
        *sessions.FACTS,
    )


def session_size(spark, sf_dir):
    return _size_out(_p(spark, sf_dir).session_size)


def session_first_changeset(spark, sf_dir):
    return sessions.first_changesets(_p(spark, sf_dir).session_rows)


def session_rate(spark, sf_dir):
    r = sessions.rate(_p(spark, sf_dir).session_size)
    return r.select(round_sig("avg_lhpe").alias("avg_lhpe"))


def session_labour(spark, sf_dir):
    return _size_out(_p(spark, sf_dir).session)


def first_contribution(spark, sf_dir):
    f = _p(spark, sf_dir).first_contribution
    return f.select("uid", "hot_project", "date", "start_of_day", interval_micros("tz_offset").alias("tz_offset_us"))


def prior_experience(spark, sf_dir):
    return _p(spark, sf_dir).prior_experience


def contribution_totals(spark, sf_dir):
    t = _p(spark, sf_dir).totals
    return t.select(
        "uid", "first_date", "last_date", "num_days_with_edits", "num_projects",
        round_sig("labour_hours").alias("labour_hours"), "num_edits",
    )


def stats_monthly(spark, sf_dir):
    return _p(spark, sf_dir).monthly()


def stats_top_projects(spark, sf_dir):
    return _p(spark, sf_dir).top_projects()


def table_inventory(spark, sf_dir):
    return _p(spark, sf_dir).inventory()


def table_sizes(spark, sf_dir):
    return _p(spark, sf_dir).sizes()


def check_unique_username(spark, sf_dir):
    return checks.duplicates(adapter.uid_username(spark, sf_dir), ["username"])


def check_unique_contributor(spark, sf_dir):
    return checks.duplicates(_p(spark, sf_dir).contributor, ["hot_project", "uid"])


def check_unique_session(spark, sf_dir):
    return checks.duplicates(_p(spark, sf_dir).session, ["uid", "hot_project", "session"])


def check_not_null(spark, sf_dir):
    return checks.null_violations_of(_p(spark, sf_dir).changeset, "changeset")


def check_unique_uid(spark, sf_dir):
    return checks.duplicates(adapter.uid_username(spark, sf_dir), ["uid"])


def check_unique_project(spark, sf_dir):
    return checks.duplicates(adapter.project_description(spark, sf_dir), ["hot_project"])


def check_unique_activity(spark, sf_dir):
    return checks.duplicates(adapter.project_activity(spark, sf_dir), ["hot_project"])


def check_unique_meta(spark, sf_dir):
    return checks.duplicates(adapter.changeset_meta(spark, sf_dir), ["changeset"])


def check_rows_and_nulls(spark, sf_dir):
    """C7 over every declared input: rows, and rows with a NULL where none may be."""
    return checks.null_counts({t: getattr(_p(spark, sf_dir).i, n) for n, t in Pipeline._DECLARED.items()})


QUERIES: dict[str, Query] = {
    name: fn
    for name, fn in [
        ("uid_username_map", uid_username_map),
        ("user_edit_history", user_edit_history),
        ("user_tag_edit_history", user_tag_edit_history),
        ("user_edit_history_way", user_edit_history_way),
        ("user_edit_history_rel", user_edit_history_rel),
        ("user_tag_edit_history_way", user_tag_edit_history_way),
        ("user_tag_edit_history_rel", user_tag_edit_history_rel),
        ("way_deletion_history", way_deletion_history),
        ("tagged_contributors", tagged_contributors),
        ("contributor_registered", contributor_registered),
        ("contributor_combined", contributor_combined),
        ("contributor_uid_list", contributor_uid_list),
        ("contributor_match_rate", contributor_match_rate),
        ("way_id_list", way_id_list),
        ("project_changeset_tag", project_changeset_tag),
        ("changeset_summary_node", changeset_summary_node),
        ("changeset_summary_way", changeset_summary_way),
        ("changeset_summary_rel", changeset_summary_rel),
        ("changeset_rollup", changeset_rollup),
        ("changeset_bbox_wkt", changeset_bbox_wkt),
        ("changeset_bbox_area", changeset_bbox_area),
        ("changeset_small_area", changeset_small_area),
        ("region_valid", region_valid),
        ("region_in_world", region_in_world),
        ("region_meets_box", region_meets_box),
        ("changeset_in_period", changeset_in_period),
        ("changeset_project", changeset_project),
        ("changeset_assigned", changeset_assigned),
        ("changeset_editor", changeset_editor),
        ("changeset_comment", changeset_comment),
        ("session_gaps", session_gaps),
        ("session_assign", session_assign),
        ("session_size", session_size),
        ("session_first_changeset", session_first_changeset),
        ("session_rate", session_rate),
        ("session_labour", session_labour),
        ("first_contribution", first_contribution),
        ("prior_experience", prior_experience),
        ("contribution_totals", contribution_totals),
        ("stats_monthly", stats_monthly),
        ("stats_top_projects", stats_top_projects),
        ("table_inventory", table_inventory),
        ("table_sizes", table_sizes),
        ("check_unique_username", check_unique_username),
        ("check_unique_contributor", check_unique_contributor),
        ("check_unique_session", check_unique_session),
        ("check_not_null", check_not_null),
        ("check_unique_uid", check_unique_uid),
        ("check_unique_project", check_unique_project),
        ("check_unique_activity", check_unique_activity),
        ("check_unique_meta", check_unique_meta),
        ("check_rows_and_nulls", check_rows_and_nulls),
    ]
}
