"""H1-H4, A9, A10, A13, C7 hand cases."""

from conftest import rows, ts

from cartoledger.operators import checks, history, stats

HIST = ("kind string, id long, version int, changeset int, timestamp timestamp_ntz, uid int, username string, "
        "latitude double, longitude double, visible boolean")


def _hist(spark):
    return spark.createDataFrame([
        ("node", 1, 1, 10, ts("2024-01-01 10:00:00"), 5, "old", 1.0, 2.0, True),
        ("node", 1, 2, 11, ts("2024-01-02 10:00:00"), 5, "new", 1.0, 2.0, True),
        ("way", 7, 1, 12, ts("2024-01-01 10:00:00"), 5, "old", None, None, True),
        ("way", 7, 2, 13, ts("2024-01-03 10:00:00"), 6, "x", None, None, False),  # deleted by an unlisted user
        ("way", 8, 1, 14, ts("2024-01-03 10:00:00"), 6, "x", None, None, False),  # way not in the list
        ("node", 2, 1, 15, ts("2024-01-01 10:00:00"), 6, "x", 3.0, 4.0, True),
    ], HIST)


def test_history_filters(spark):
    h = _hist(spark)
    assert dict(rows(history.uid_username(h))) == {5: "new", 6: "x"}
    uids = spark.createDataFrame([(5,)], "uid int")
    assert [r.id for r in history.user_edits(h, uids, "node").collect()] == [1, 1]
    assert history.user_edits(h, uids, "node").columns == ["id", "version", "changeset", "timestamp", "uid", "latitude", "longitude", "visible"]
    ids = spark.createDataFrame([(7,)], "id long")
    assert rows(history.way_deletions(h, ids)) == [(7, 2, 13, ts("2024-01-03 10:00:00"), 6)]


def test_tag_history_filter(spark):
    th = spark.createDataFrame([("node", 1, 1, 10, ts("2024-01-01 10:00:00"), 5, "k", "v"),
                                ("way", 1, 1, 10, ts("2024-01-01 10:00:00"), 5, "k", "v"),
                                ("node", 2, 1, 10, ts("2024-01-01 10:00:00"), 6, "k", "w")],
                               "kind string, id long, version int, changeset int, timestamp timestamp_ntz, uid int, key string, value string")
    uids = spark.createDataFrame([(5,)], "uid int")
    assert [(r.id, r.value) for r in history.user_tag_edits(th, uids, "node").collect()] == [(1, "v")]


ASSIGNED = "changeset int, uid int, hot_project int, last_date timestamp_ntz, num_edits int"
DESC = "hot_project int, title string, is_private boolean, is_archived boolean, is_draft boolean, changeset_comment string"


def test_top_projects_and_monthly(spark):
    long_title = "x" * 50
    a = spark.createDataFrame([
        (1, 1, 1, ts("2024-01-05 00:00:00"), 3), (1, 1, 2, ts("2024-01-05 00:00:00"), 3),  # one changeset, two projects
        (2, 2, 2, ts("2024-02-01 00:00:00"), 4), (3, 3, 3, ts("2024-02-01 00:00:00"), 5),
    ], ASSIGNED)
    d = spark.createDataFrame([(1, long_title + "A", True, False, False, None), (2, long_title + "B", False, True, False, None),
                               (3, "c", False, False, True, None)], DESC)
    top = stats.top_projects(a, d).collect()
    assert [(r.hot_project, r.num_users, r.num_edits, r.num_changesets) for r in top] == [(2, 2, 7, 2), (1, 1, 3, 1), (3, 1, 5, 1)]
    assert top[0].title == long_title and (top[0].priv, top[0].arch, top[0].draft) == ("", "t", "")
    assert len(stats.top_projects(a, d, n=1).collect()) == 1
    m = {r.month: (r.num_projects, r.num_users, r.num_edits) for r in stats.monthly(a).collect()}
    assert m == {"2024-01": (2, 1, 6), "2024-02": (2, 2, 9)}
    inv = dict(rows(stats.inventory({"a": a, "d": d})))
    assert inv == {"a": 4, "d": 3}


def test_not_null_check(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "changeset int, uid int")
    assert rows(checks.null_violations(df, ["changeset", "uid"])) == [(1, None)]
