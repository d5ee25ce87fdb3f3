"""Declared table schemas.

Every input and derived table has a fixed schema; ``nullable=False`` marks the
NOT NULL columns that ``checks.check_not_null`` (C7) enforces after the fact.
"""

from __future__ import annotations

from pyspark.sql import types as T

I = T.IntegerType()
L = T.LongType()
S = T.StringType()
B = T.BooleanType()
D = T.DoubleType()
TS = T.TimestampNTZType()
DT = T.DayTimeIntervalType()


def _s(*cols) -> T.StructType:
    return T.StructType([T.StructField(name, typ, nullable) for name, typ, nullable in cols])


_EDIT_HEAD = (("id", L, False), ("version", I, False), ("changeset", I, False), ("timestamp", TS, False), ("uid", I, True))

SCHEMAS: dict[str, T.StructType] = {
    # inputs
    "hot_project_registered_contributor_name": _s(("hot_project", I, False), ("username", S, False), ("num_tasks", I, False)),
    "uid_username": _s(("uid", I, False), ("username", S, False)),
    "hot_project_history_contributor": _s(
        ("hot_tag", S, False), ("hot_project", I, False), ("uid", I, False), ("username", S, False)
    ),
    "hot_project_description": _s(
        ("hot_project", I, False), ("title", S, True), ("is_private", B, False), ("is_archived", B, False),
        ("is_draft", B, False), ("changeset_comment", S, True),
    ),
    "hot_project_activity": _s(
        ("hot_project", I, False), ("first_date", TS, False), ("last_date", TS, False),
        ("perc_done", D, True), ("perc_validated", D, True),
    ),
    "hot_project_tasks": _s(("hot_project", I, False), ("num_tasks", I, False)),
    "hot_project_region": _s(
        ("hot_project", I, True),
        ("geom", T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(D)))), True),
    ),
    "node_edits": _s(*_EDIT_HEAD, ("latitude", D, True), ("longitude", D, True), ("visible", B, False)),
    "way_edits": _s(*_EDIT_HEAD, ("visible", B, False)),
    "rel_edits": _s(*_EDIT_HEAD, ("visible", B, False)),
    "history": _s(
        ("kind", S, False), *_EDIT_HEAD, ("username", S, True), ("latitude", D, True), ("longitude", D, True),
        ("visible", B, False),
    ),
    "tag_history": _s(("kind", S, False), *_EDIT_HEAD, ("key", S, True), ("value", S, True)),
    "node_tag_edits": _s(*_EDIT_HEAD, ("key", S, True), ("value", S, True)),
    "way_tag_edits": _s(*_EDIT_HEAD, ("key", S, True), ("value", S, True)),
    "rel_tag_edits": _s(*_EDIT_HEAD, ("key", S, True), ("value", S, True)),
    "way_deletions": _s(*_EDIT_HEAD),
    "changeset_meta": _s(
        ("changeset", I, False), ("created_at", TS, False), ("closed_at", TS, False), ("uid", I, False),
        ("username", S, False), ("num_changes", I, False), ("comments_count", I, False),
    ),
    "changeset_meta_tags": _s(("changeset", I, False), ("key", S, False), ("value", S, True)),
    # derived
    "hot_project_registered_contributor": _s(
        ("hot_project", I, False), ("uid", I, True), ("username", S, False), ("num_tasks", I, False)
    ),
    "hot_project_contributor": _s(
        ("hot_project", I, False), ("uid", I, False), ("username", S, False), ("has_submitted_tasks", B, False)
    ),
    "hot_project_changeset_tag": _s(("hot_project", I, False), ("hot_tag", S, False)),
    "changeset": _s(
        ("changeset", I, False), ("uid", I, False), ("first_date", TS, False), ("last_date", TS, False),
        ("min_lat", D, True), ("max_lat", D, True), ("min_lon", D, True), ("max_lon", D, True),
        ("node_edits", I, False), ("way_edits", I, False), ("rel_edits", I, False), ("num_edits", I, False),
    ),
    "changeset_hot_project": _s(("changeset", I, False), ("hot_project", I, False)),
    "changeset_editor": _s(("changeset", I, False), ("editor", S, False), ("editor_full", S, True)),
    "changeset_comment": _s(("changeset", I, False), ("comment", S, False)),
    "user_hmp_session_changeset": _s(
        ("uid", I, False), ("hot_project", I, False), ("session", L, False), ("changeset", I, False)
    ),
    "user_hmp_session": _s(
        ("uid", I, True), ("hot_project", I, True), ("session", L, True), ("first_date", TS, True),
        ("last_date", TS, True), ("labour_hours", D, True), ("node_edits", L, True), ("way_edits", L, True),
        ("rel_edits", L, True), ("num_edits", L, True),
    ),
    "user_first_hot_contribution": _s(
        ("uid", I, True), ("hot_project", I, True), ("date", TS, True), ("start_of_day", TS, True), ("tz_offset", DT, True)
    ),
    "user_prior_experience": _s(("uid", I, True), ("num_days_with_edits", L, True)),
    "user_hot_contributions": _s(
        ("uid", I, True), ("first_date", TS, True), ("last_date", TS, True), ("num_days_with_edits", L, True),
        ("num_projects", L, True), ("labour_hours", D, True), ("num_edits", L, True),
    ),
}


def not_null_columns(table: str) -> list[str]:
    """Columns declared NOT NULL for ``table``."""
    return [f.name for f in SCHEMAS[table].fields if not f.nullable]
