"""J1, J2, C3, C8, S4 hand cases."""

from conftest import rows

from cartoledger.operators import checks, contributors

REG = "hot_project int, uid int, username string, num_tasks int"
HIST = "hot_tag string, hot_project int, uid int, username string"


def test_combined_rules(spark):
    reg = spark.createDataFrame([(1, 10, "alice", 3), (1, None, "ghost", 2), (2, 11, "bob", 1)], REG)
    hist = spark.createDataFrame([
        ("#t-1", 1, 10, "alice_old"),  # both sides, different names -> registered name, flag true
        ("#t-3", 3, 12, "carol"), ("#t-3", 3, 12, "carol"),  # tag side twice -> one row
        ("#t-4", 4, 13, "dan"), ("#t-4", 4, 13, "daniel"),  # two names -> two rows, reported by C3
    ], HIST)
    out = contributors.combined(reg, hist)
    assert rows(out) == [(1, 10, "alice", True), (2, 11, "bob", True), (3, 12, "carol", False),
                         (4, 13, "dan", False), (4, 13, "daniel", False)]
    dup = rows(checks.duplicates(out, ["hot_project", "uid"]))
    assert dup == [(4, 13, 2)]


def test_registered_and_match_rate(spark):
    names = spark.createDataFrame([(1, "alice", 3), (1, "nobody", 1), (2, "alice", 2)], "hot_project int, username string, num_tasks int")
    uu = spark.createDataFrame([(10, "alice")], "uid int, username string")
    reg = contributors.registered(names, uu)
    assert rows(reg) == [(1, 10, "alice", 3), (1, None, "nobody", 1), (2, 10, "alice", 2)]
    assert rows(contributors.match_rate(reg)) == [(False, 1), (True, 1)]
    assert rows(contributors.uid_list(reg)) == [(10,)]


def test_tagged_contributors(spark):
    meta = spark.createDataFrame([(1, 5, "eve"), (2, 6, "fay")], "changeset int, uid int, username string")
    tags = spark.createDataFrame(
        [(1, "comment", "#hotosm-project-3 and #hotosm-project-4"), (2, "comment", "no tag"), (2, "created_by", "#hotosm-project-9")],
        "changeset int, key string, value string",
    )
    assert rows(contributors.tagged_contributors(meta, tags)) == [
        ("#hotosm-project-3", 3, 5, "eve"), ("#hotosm-project-4", 4, 5, "eve")
    ]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_names = st.sampled_from(["a", "b", "c"])
_reg = st.tuples(st.integers(1, 2), st.one_of(st.none(), st.integers(1, 3)), _names, st.integers(1, 4))
_hist = st.tuples(st.integers(1, 2), st.integers(1, 3), _names)


def _reference_form(reg, hist):
    """The reference's FULL OUTER JOIN on (project, uid) + COALESCE + GROUP BY, emulated row by row."""
    hp = [(p, u, n, True) for (p, u, n, _) in reg if u is not None]
    hc = [(p, u, n, None) for (p, u, n) in hist]
    out = set()
    for a in hp:
        out.add(a)  # every registered row appears, coalesce takes its values
    for b in hc:
        if not any(a[0] == b[0] and a[1] == b[1] for a in hp):
            out.add((b[0], b[1], b[2], False))  # unmatched tag side: has_submitted_tasks false
    return sorted(out)


@settings(max_examples=15, deadline=None)
@given(st.lists(_reg, max_size=8), st.lists(_hist, max_size=8))
def test_combined_equals_reference_form(spark, reg, hist):
    r = spark.createDataFrame(reg, REG)
    h = spark.createDataFrame([("#t", p, u, n) for (p, u, n) in hist], HIST)
    got = sorted(tuple(x) for x in contributors.combined(r, h).collect())
    assert got == _reference_form(reg, hist)


def test_tag_number_too_long_for_an_id(spark):
    """A 12-digit number in free text names no project and does not stop the job."""
    meta = spark.createDataFrame([(1, 7, "ann"), (2, 8, "bob")], "changeset int, uid int, username string")
    text = "#hotosm-project-99999999999 and #hotosm-project-5"
    tags = spark.createDataFrame([(1, "comment", text), (2, "comment", None)], "changeset int, key string, value string")
    got = contributors.tagged_contributors(meta, tags).collect()
    assert [tuple(r) for r in got] == [("#hotosm-project-5", 5, 7, "ann")]
