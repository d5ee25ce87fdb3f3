"""J7, J8 hand cases."""

from conftest import ts

from cartoledger.operators import assign

CS = ("changeset int, uid int, first_date timestamp_ntz, last_date timestamp_ntz, min_lat double, max_lat double, "
      "min_lon double, max_lon double, node_edits int, way_edits int, rel_edits int, num_edits int")


def _square(x0, y0, x1, y1):
    x0, y0, x1, y1 = (float(v) for v in (x0, y0, x1, y1))
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


def test_assignment_rules(spark):
    region = spark.createDataFrame(
        [(p, [[_square(0, 0, 1, 1)]]) for p in (1, 2, 3, 4)], "hot_project int, geom array<array<array<array<double>>>>"
    )
    desc = spark.createDataFrame(
        [(1, "a", False, True, False, None), (2, "b", True, False, False, None), (3, "c", False, False, True, None),
         (4, "d", False, False, False, None)],
        "hot_project int, title string, is_private boolean, is_archived boolean, is_draft boolean, changeset_comment string",
    )
    act = spark.createDataFrame(
        [(p, ts("2024-01-01 00:00:00"), ts("2024-01-10 00:00:00"), None, None) for p in (1, 2, 3, 4)],
        "hot_project int, first_date timestamp_ntz, last_date timestamp_ntz, perc_done double, perc_validated double",
    )
    contrib = spark.createDataFrame(
        [(p, 7, "u", True) for p in (1, 2, 3, 4)], "hot_project int, uid int, username string, has_submitted_tasks boolean"
    )
    box = (0.2, 0.25, 0.2, 0.25)
    cs = spark.createDataFrame([
        (1, 7, ts("2024-01-10 00:00:00"), ts("2024-01-10 01:00:00"), *box, 1, 0, 0, 1),  # starts exactly at the end
        (2, 7, ts("2024-01-10 00:00:00.000001"), ts("2024-01-10 01:00:00"), *box, 1, 0, 0, 1),  # 1 us after
        (3, 8, ts("2024-01-05 00:00:00"), ts("2024-01-05 01:00:00"), *box, 1, 0, 0, 1),  # not a contributor
        (4, 7, ts("2024-01-05 00:00:00"), ts("2024-01-05 01:00:00"), None, None, None, None, 0, 1, 0, 1),  # no box
        (5, 7, ts("2024-01-05 00:00:00"), ts("2024-01-05 01:00:00"), 0.0, 1.0, 0.0, 1.0, 1, 0, 0, 1),  # > 100 km2
    ], CS)
    got = sorted(tuple(r) for r in assign.assign(cs, region, contrib, act, desc).collect())
    # archived project 1 and plain project 4 kept; private 2 and draft 3 dropped; one changeset, two projects
    assert got == [(1, 1), (1, 4)]
    period = sorted(tuple(r) for r in assign.in_period(cs, contrib, act).collect())
    assert (1, 1) in period and (2, 1) not in period
