"""W4, A7, A8, J14, J15 hand cases."""

import datetime as dt

from conftest import ts

from cartoledger.operators import contributions

SESSION = ("uid int, hot_project int, session long, first_date timestamp_ntz, last_date timestamp_ntz, "
           "labour_hours double, node_edits long, way_edits long, rel_edits long, num_edits long")
CHANGESET = "changeset int, uid int, first_date timestamp_ntz, last_date timestamp_ntz"


def test_first_contribution_tie_and_offset(spark):
    s = spark.createDataFrame([
        (1, 7, 3, ts("2024-01-05 15:30:00"), ts("2024-01-05 16:00:00"), 1.0, 1, 0, 0, 1),
        (1, 4, 2, ts("2024-01-05 15:30:00"), ts("2024-01-05 16:00:00"), 1.0, 1, 0, 0, 1),  # same start: lower project
        (1, 2, 9, ts("2024-01-06 09:00:00"), ts("2024-01-06 10:00:00"), 1.0, 1, 0, 0, 1),
    ], SESSION)
    r = contributions.first_contribution(s).first()
    assert (r.uid, r.hot_project, r.date) == (1, 4, ts("2024-01-05 15:30:00"))
    assert r.start_of_day == ts("2024-01-05 03:30:00")
    assert r.tz_offset == dt.timedelta(hours=15, minutes=30)


def test_prior_experience_rules(spark):
    s = spark.createDataFrame([
        (1, 1, 1, ts("2024-01-10 15:00:00"), ts("2024-01-10 16:00:00"), 1.0, 1, 0, 0, 1),
        (2, 1, 2, ts("2024-01-10 15:00:00"), ts("2024-01-10 16:00:00"), 1.0, 1, 0, 0, 1),
    ], SESSION)
    first = contributions.first_contribution(s)
    cs = spark.createDataFrame([
        (1, 1, ts("2024-01-08 14:00:00"), ts("2024-01-08 14:30:00")),  # phase day of 2024-01-07
        (2, 1, ts("2024-01-08 16:00:00"), ts("2024-01-08 16:30:00")),  # phase day of 2024-01-08
        (3, 1, ts("2024-01-08 17:00:00"), ts("2024-01-08 17:30:00")),  # same phase day
        (4, 1, ts("2024-01-10 05:00:00"), ts("2024-01-10 05:00:00")),  # less than 12 h before: not counted
    ], CHANGESET)
    got = {r.uid: r.num_days_with_edits for r in contributions.prior_experience(first, cs).collect()}
    assert got == {1: 2, 2: 0}


def test_totals(spark):
    s = spark.createDataFrame([
        (1, 1, 1, ts("2024-01-10 15:00:00"), ts("2024-01-10 16:00:00"), 1.5, 1, 0, 0, 3),
        (1, 2, 2, ts("2024-01-11 10:00:00"), ts("2024-01-11 11:00:00"), 0.5, 1, 0, 0, 4),  # same phase day
        (1, 2, 3, ts("2024-01-12 16:00:00"), ts("2024-01-12 17:00:00"), 1.0, 1, 0, 0, 5),
    ], SESSION)
    first = contributions.first_contribution(s)
    r = contributions.totals(first, s).first()
    assert (r.num_days_with_edits, r.num_projects, r.labour_hours, r.num_edits) == (2, 2, 3.0, 12)
    assert (r.first_date, r.last_date) == (ts("2024-01-10 15:00:00"), ts("2024-01-12 17:00:00"))


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_t = st.integers(min_value=0, max_value=60 * 24 * 10)  # minutes after 2024-01-01


def _prior_reference_form(first_sessions, changesets):
    """DISTINCT ON (uid) first session; LEFT JOIN changesets ending before start_of_day; distinct shifted days."""
    base = dt.datetime(2024, 1, 1)
    out = {}
    for uid in {s[0] for s in first_sessions}:
        first = min((base + dt.timedelta(minutes=m)) for (u, m) in first_sessions if u == uid)
        offset = first - dt.datetime.combine(first.date(), dt.time())
        start_of_day = first - dt.timedelta(hours=12)
        days = set()
        for (u, a, b) in changesets:
            fa, lb = base + dt.timedelta(minutes=a), base + dt.timedelta(minutes=a + b)
            if u == uid and lb < start_of_day:
                days.add((fa - offset).date())
        out[uid] = len(days)
    return out


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 3), _t), min_size=1, max_size=6),
    st.lists(st.tuples(st.integers(1, 3), _t, st.integers(0, 300)), max_size=25),
)
def test_prior_experience_equals_reference_form(spark, first_sessions, changesets):
    base = dt.datetime(2024, 1, 1)
    s = spark.createDataFrame(
        [(u, 1, i, base + dt.timedelta(minutes=m), base + dt.timedelta(minutes=m + 5), 1.0, 1, 0, 0, 1)
         for i, (u, m) in enumerate(first_sessions)], SESSION)
    cs = spark.createDataFrame(
        [(i, u, base + dt.timedelta(minutes=a), base + dt.timedelta(minutes=a + b)) for i, (u, a, b) in enumerate(changesets)],
        CHANGESET)
    got = {r.uid: r.num_days_with_edits for r in contributions.prior_experience(contributions.first_contribution(s), cs).collect()}
    assert got == _prior_reference_form(first_sessions, changesets)
