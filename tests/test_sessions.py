"""W1-W3, W5, A5, A6, J12, J13 hand cases and properties."""

import datetime as dt
import random

from conftest import ts

from cartoledger.operators import sessions

SCHEMA = ("uid int, hot_project int, changeset int, first_date timestamp_ntz, last_date timestamp_ntz, "
          "node_edits int, way_edits int, rel_edits int, num_edits int")


def _assigned(spark, data):
    full = [(u, p, c, ts(a), ts(b), n, 0, 0, n) for (u, p, c, a, b, n) in data]
    return spark.createDataFrame(full, SCHEMA)


def _sessions_of(df):
    out = {}
    for r in df.collect():
        out[(r.hot_project, r.changeset)] = r.session
    return out


def test_gap_rules(spark):
    data = [
        (1, 1, 1, "2024-01-01 10:00:00", "2024-01-01 11:00:00", 1),
        (1, 1, 2, "2024-01-01 12:00:00", "2024-01-01 12:10:00", 1),  # gap exactly 1 h -> same
        (1, 1, 3, "2024-01-01 13:10:00.000001", "2024-01-01 13:20:00", 1),  # 1 h + 1 us -> new
        (1, 1, 4, "2024-01-01 13:15:00", "2024-01-01 13:30:00", 1),  # overlap (negative gap) -> same
        # A 10:00-14:00, B 10:10-10:20, C from 12:00: C is 1 h 40 min after B's end -> new
        (2, 1, 10, "2024-01-01 10:00:00", "2024-01-01 14:00:00", 1),
        (2, 1, 11, "2024-01-01 10:10:00", "2024-01-01 10:20:00", 1),
        (2, 1, 12, "2024-01-01 12:00:00", "2024-01-01 12:05:00", 1),
        # same user, second project -> separate ids; equal first_date -> order by changeset
        (2, 2, 10, "2024-01-01 10:00:00", "2024-01-01 14:00:00", 1),
        (2, 2, 13, "2024-01-01 10:00:00", "2024-01-01 10:00:00", 1),
    ]
    s = sessions.sessionize(_assigned(spark, data))
    got = _sessions_of(s)
    assert got[(1, 1)] == got[(1, 2)] == 1
    assert got[(1, 3)] == got[(1, 4)] == 2
    assert got[(1, 10)] == got[(1, 11)] == 3
    assert got[(1, 12)] == 4
    assert got[(2, 10)] == got[(2, 13)] == 5
    gaps = {(r.hot_project, r.changeset): r.time_since_prev_cs for r in s.collect()}
    assert gaps[(1, 2)] == dt.timedelta(hours=1)
    assert gaps[(1, 4)] == dt.timedelta(minutes=-5)
    assert gaps[(2, 13)] == dt.timedelta(hours=-4)  # previous row by changeset order is 10


def _brute_force(data, timeout=dt.timedelta(hours=1)):
    rows = sorted(data, key=lambda r: (r[0], r[1], r[3], r[2]))
    sid, prev, out = 0, None, {}
    for r in rows:
        new = prev is None or prev[:2] != r[:2] or (r[3] - prev[4]) > timeout
        sid += 1 if new else 0
        out[(r[0], r[1], r[2])] = sid
        prev = r
    return out


def test_matches_serial_scan_on_hot_group(spark):
    """A hot (uid, project) over many day buckets numbers exactly like one serial scan."""
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    data = []
    cs = 0
    for uid, n in ((1, 400), (2, 30), (3, 5)):
        for _ in range(n):
            cs += 1
            start = base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 20))
            end = start + dt.timedelta(minutes=rnd.randrange(0, 150))
            data.append((uid, 1 + (cs % 2 if uid == 2 else 0), cs, start, end, 1, 0, 0, 1))
    df = spark.createDataFrame(data, SCHEMA)
    got = {(r.uid, r.hot_project, r.changeset): r.session for r in sessions.sessionize(df, n_parts=3).collect()}
    assert got == _brute_force(data)


def test_labour_hours(spark):
    data = [
        (1, 1, 1, "2024-01-01 10:00:00", "2024-01-01 10:00:00", 2),  # single changeset: raw 0 h
        (2, 1, 2, "2024-01-01 10:00:00", "2024-01-01 11:00:00", 4),  # 1 h over 4 edits
        (2, 1, 3, "2024-01-01 11:30:00", "2024-01-01 12:00:00", 6),
    ]
    s = sessions.sessionize(_assigned(spark, data))
    size = sessions.sizes(s)
    rate = sessions.rate(size).first().avg_lhpe
    assert rate == 2.0 / 10
    out = {r.uid: r for r in sessions.labour(size).collect()}
    assert out[1].labour_hours == 0.0 + rate * 2
    assert out[2].labour_hours == 2.0 + rate * 4
    assert out[2].num_edits == 10
    first = {r.session: (r.changeset, r.num_edits) for r in sessions.first_changesets(s).collect()}
    assert sorted(first.values()) == [(1, 2), (2, 4)]


def test_no_positive_hours_gives_null(spark):
    data = [(1, 1, 1, "2024-01-01 10:00:00", "2024-01-01 10:00:00", 2)]
    out = sessions.labour(sessions.sizes(sessions.sessionize(_assigned(spark, data)))).collect()
    assert out[0].labour_hours is None


def test_exclusive_prefix_sum(spark):
    df = spark.createDataFrame([(k, k % 3 + 1) for k in range(50)], "k int, v int")
    out = {r.k: r.o for r in sessions.exclusive_prefix_sum(df, ["k"], "v", "o", 4).collect()}
    run = 0
    for k in range(50):
        assert out[k] == run
        run += k % 3 + 1


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_minutes = st.integers(min_value=0, max_value=60 * 24 * 6)
_changeset = st.tuples(
    st.integers(min_value=1, max_value=3),  # uid
    st.integers(min_value=1, max_value=2),  # project
    _minutes,  # start, minutes after 2024-01-01
    st.sampled_from([0, 5, 30, 60, 61, 120, 600]),  # duration, minutes
)


@settings(max_examples=12, deadline=None)
@given(st.lists(_changeset, min_size=1, max_size=60), st.integers(min_value=1, max_value=5))
def test_sessionize_equals_serial_scan(spark, items, n_parts):
    base = dt.datetime(2024, 1, 1)
    data = []
    for cs, (uid, proj, start, dur) in enumerate(items, start=1):
        a = base + dt.timedelta(minutes=start)
        data.append((uid, proj, cs, a, a + dt.timedelta(minutes=dur), 1, 0, 0, 1))
    df = spark.createDataFrame(data, SCHEMA)
    got = {(r.uid, r.hot_project, r.changeset): r.session for r in sessions.sessionize(df, n_parts=n_parts).collect()}
    assert got == _brute_force(data)


def test_ids_do_not_depend_on_the_optimizer(spark):
    """Ids are those of a serial scan with exchange reuse and AQE on or off, for 1, 4 and 16 partitions."""
    import random

    from pyspark.sql import functions as F

    draw = random.Random(2)
    rows_ = [(i, draw.randrange(300), draw.randrange(3), draw.randrange(60)) for i in range(3000)]
    df = spark.createDataFrame(rows_, "changeset int, uid int, hot_project int, h int")
    start = F.timestamp_ntz_from_parts if hasattr(F, "timestamp_ntz_from_parts") else None
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    df = df.withColumn("first_date", base + F.make_dt_interval(F.lit(0), "h")).withColumn("last_date", F.col("first_date"))
    df = df.withColumns({c: F.lit(1) for c in ("node_edits", "way_edits", "rel_edits", "num_edits")}).drop("h")
    del start
    want, last, n = {}, None, 0
    for c, u, p, h in sorted(rows_, key=lambda r: (r[1], r[2], r[3], r[0])):
        if last is None or last[:2] != (u, p) or h - last[2] > 1:
            n += 1
        want[c, p], last = n, (u, p, h)
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    try:
        for reuse, aqe, parts in (("false", "true", 4), ("true", "false", 16), ("false", "false", 1)):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            spark.conf.set("spark.sql.adaptive.enabled", aqe)
            got = sessions.sessionize(df, n_parts=parts).collect()
            assert {(r.changeset, r.hot_project): r.session for r in got} == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
