"""A1-A4, J3, P1-P3, J9 hand cases (FIXTURES section 3)."""

from conftest import rows, ts

from cartoledger.operators import changesets
from cartoledger.schemas import SCHEMAS

NODE = SCHEMAS["node_edits"]
WAY = SCHEMAS["way_edits"]


def _node(spark, data):
    return spark.createDataFrame(data, NODE)


def _way(spark, data):
    return spark.createDataFrame(data, WAY)


def test_rollup_kinds_and_uid_preference(spark):
    nodes = _node(spark, [
        (1, 1, 10, ts("2024-01-01 10:00:00"), 5, 1.0, 2.0, True),
        (2, 1, 10, ts("2024-01-01 10:05:00"), 5, 1.5, 2.5, True),
        (3, 1, 30, ts("2024-01-01 09:00:00"), 7, None, None, True),  # node with no coordinates
    ])
    ways = _way(spark, [
        (4, 1, 10, ts("2024-01-01 09:59:00"), 3, True),
        (5, 1, 20, ts("2024-01-02 00:00:00"), 9, True),  # only way edits
    ])
    rels = spark.createDataFrame([(6, 1, 30, ts("2024-01-01 11:00:00"), 8, True)], SCHEMAS["rel_edits"])
    out = {r.changeset: r for r in changesets.rollup(nodes, ways, rels).collect()}
    c10 = out[10]
    assert c10.uid == 5  # node uid wins over way uid
    assert c10.first_date == ts("2024-01-01 09:59:00") and c10.last_date == ts("2024-01-01 10:05:00")
    assert (c10.min_lat, c10.max_lat, c10.min_lon, c10.max_lon) == (1.0, 1.5, 2.0, 2.5)
    assert (c10.node_edits, c10.way_edits, c10.rel_edits, c10.num_edits) == (2, 1, 0, 3)
    c20 = out[20]
    assert c20.min_lat is None and c20.node_edits == 0 and c20.num_edits == 1 and c20.uid == 9
    c30 = out[30]  # node + relation only; NULL coordinates -> no box
    assert c30.min_lat is None and c30.node_edits == 1 and c30.rel_edits == 1 and c30.uid == 7
    assert c30.last_date == ts("2024-01-01 11:00:00")


def test_rollup_equals_summaries(spark):
    nodes = _node(spark, [(i, 1, i % 3, ts("2024-01-01 10:00:00"), i, float(i), float(-i), True) for i in range(9)])
    ways = _way(spark, [(i, 1, i % 4, ts("2024-01-01 11:00:00"), i, True) for i in range(8)])
    rels = spark.createDataFrame([], SCHEMAS["rel_edits"])
    roll = changesets.rollup(nodes, ways, rels)
    total = sum(r.num_edits for r in roll.collect())
    assert total == 17
    n = {r.changeset: r.num_edits for r in changesets.summary_node(nodes).collect()}
    assert n == {0: 3, 1: 3, 2: 3}


def test_project_tag_rules(spark):
    from pyspark.sql import types as T

    data = [
        (1, "a #hotosm-project-1 b #hotosm-project-22 c"),
        (2, "first #hotosm-x-1\nsecond #hotosm-y-2"),
        (3, "#hotosm-12"),
        (4, "#hotosm-a-1-2 done"),
        (5, "#hotosm-p-12abc"),
        (6, None),
    ]
    desc = spark.createDataFrame(data, T.StructType([T.StructField("hot_project", T.IntegerType()), T.StructField("changeset_comment", T.StringType())]))
    got = dict(rows(changesets.project_tags(desc)))
    assert got == {1: "#hotosm-project-22", 2: "#hotosm-y-2", 4: "#hotosm-a-1-2", 5: "#hotosm-p-12"}


def test_editor_and_comment(spark):
    from pyspark.sql import types as T

    cs = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,)], "changeset int")
    tags = spark.createDataFrame(
        [
            (1, "created_by", "JOSM/1.5"),
            (2, "created_by", "josm"),
            (3, "created_by", None),
            (5, "created_by", "iD 2.0"),
            (5, "created_by", "Potlatch 2"),
            (1, "comment", ""),
            (2, "comment", None),
            (3, "comment", " "),
            (4, "comment", "hello"),
        ],
        T.StructType([T.StructField("changeset", T.IntegerType()), T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]),
    )
    ed = rows(changesets.editors(cs, tags))
    assert ed == sorted([
        (1, "JOSM", "JOSM/1.5"), (2, "Other", "josm"), (3, "Other", None), (4, "Other", None),
        (5, "iD", "iD 2.0"), (5, "Potlatch", "Potlatch 2"),
    ], key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows(changesets.comments(tags)) == [(3, " "), (4, "hello")]
