"""Edit sessions and labour hours.

A session is a run of one user's changesets in one project where each
changeset starts at most ``timeout`` after the previous one (ordered by start)
ended. Labour hours are the session's span plus an estimate for the time
before its first save: the global mean hours-per-edit times the first
changeset's edits.

Scale: a single (uid, project) group may hold a large share of all changesets
(bots, power mappers). Windows over such a group would land in one task, so
rows are windowed per (uid, project, time bucket) instead; the one value that
crosses a bucket edge (the previous row's end) and the running session counts
are carried between buckets through a small per-bucket table. Session ids are
a dense global numbering in (uid, project, start, changeset) order, computed
with range partitioning and per-partition offsets: no step puts all rows, or
all groups, in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeops import hours_between, micros_between
from ..session import stage

KEY = ["uid", "hot_project"]
ORDER = ["first_date", "changeset"]
FACTS = ["node_edits", "way_edits", "rel_edits", "num_edits"]
# Fixed value of the reference: a gap longer than one hour starts a new session.
DEFAULT_TIMEOUT_HOURS = 1
DEFAULT_BUCKET = "DAY"

_UNBOUNDED = Window.unboundedPreceding


def exclusive_prefix_sum(df: DataFrame, order_cols: list[str], value_col: str, out_col: str, n_parts: int) -> DataFrame:
    """``out_col`` = sum of ``value_col`` over all rows before this one in ``order_cols`` order.

    Rows are range-partitioned and stored with their partition number; each
    partition is prefix-summed on its own and offset by the totals of the
    partitions before it (a table of ``n_parts`` rows). The number is read back
    from the stored rows by both uses: range bounds come from sampling, so two
    evaluations of the exchange could disagree.
    """
    ranged = stage(
        df.repartitionByRange(n_parts, *order_cols).withColumn("_pid", F.spark_partition_id()), "range_parts"
    )
    w = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(_UNBOUNDED, Window.currentRow)
    local = ranged.withColumn("_incl", F.sum(value_col).over(w))
    totals = local.groupBy("_pid").agg(F.max("_incl").alias("_ptot"))
    before = Window.orderBy("_pid").rowsBetween(_UNBOUNDED, -1)  # at most n_parts rows
    offsets = totals.select("_pid", F.coalesce(F.sum("_ptot").over(before), F.lit(0)).alias("_pofs"))
    return (
        local.join(F.broadcast(offsets), "_pid")
        .withColumn(out_col, F.col("_pofs") + F.col("_incl") - F.col(value_col))
        .drop("_pid", "_incl", "_pofs")
    )


def _bucket_of(ts, bucket: str):
    """Calendar bucket of a TIMESTAMP_NTZ as a DATE; zone-free (no session time zone involved)."""
    day = F.to_date(ts)
    return day if bucket.upper() == "DAY" else F.trunc(day, bucket.lower())


def sessionize(
    assigned: DataFrame,
    timeout_hours: float = DEFAULT_TIMEOUT_HOURS,
    bucket: str = DEFAULT_BUCKET,
    n_parts: int | None = None,
) -> DataFrame:
    """W1 + W2 + W5 over assigned changesets, keeping every input column.

    Adds ``time_since_prev_cs`` (interval; NULL for a session start) and
    ``session`` (long, dense from 1 in (uid, hot_project, first_date, changeset) order).
    Ties on first_date are broken by changeset (the reference leaves them open).

    A window pass per (uid, hot_project, bucket) gives each row its in-bucket
    predecessor and the running count of session starts that the bucket decides
    by itself. A per-bucket table (one row per user, project and bucket, stored
    once from a narrow shuffle of the keys and dates) then settles whether each
    bucket's first row starts a session (it needs the previous bucket's last
    end) and the offset of every bucket; one join brings that back to the rows,
    in the one shuffle that carries all their columns.
    """
    spark = assigned.sparkSession
    n_parts = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    timeout_us = int(round(timeout_hours * 3_600_000_000))

    def too_long(prev, start):
        return micros_between(prev, start) > F.lit(timeout_us)

    bkey = KEY + ["_b"]
    w_in = Window.partitionBy(*bkey).orderBy(*ORDER)
    rows = assigned.withColumn("_b", _bucket_of(F.col("first_date"), bucket))
    rows = rows.withColumn("_prev_in", F.lag("last_date").over(w_in))
    rows = rows.withColumn(
        "_n_in",
        F.sum(F.coalesce(too_long(F.col("_prev_in"), F.col("first_date")), F.lit(False)).cast("long")).over(
            w_in.rowsBetween(_UNBOUNDED, Window.currentRow)
        ),
    )

    # One row per bucket: its first start, its last row's end, its own session starts.
    buckets = stage(
        rows.groupBy(*bkey).agg(
            F.min("first_date").alias("_b_first"),
            F.max_by("last_date", F.struct(*ORDER)).alias("_b_last"),
            F.max("_n_in").alias("_b_inner"),
        ),
        "buckets",
    )
    w_b = Window.partitionBy(*KEY).orderBy("_b")
    prev_b = F.lag("_b_last").over(w_b)
    buckets = buckets.withColumn("_prev_b", prev_b).withColumn(
        "_b_new", F.coalesce(too_long(F.col("_prev_b"), F.col("_b_first")), F.lit(True)).cast("long")
    )
    buckets = buckets.withColumn("_b_starts", F.col("_b_new") + F.col("_b_inner")).withColumn(
        "_b_ofs", F.coalesce(F.sum("_b_starts").over(w_b.rowsBetween(_UNBOUNDED, -1)), F.lit(0))
    )
    groups = buckets.groupBy(*KEY).agg(F.sum("_b_starts").alias("_gn"))
    groups = exclusive_prefix_sum(groups, KEY, "_gn", "_g_ofs", n_parts)
    buckets = buckets.join(groups.select(*KEY, "_g_ofs"), KEY).select(
        *bkey, "_prev_b", "_b_new", (F.col("_g_ofs") + F.col("_b_ofs")).alias("_ofs")
    )

    out = rows.join(buckets, bkey)
    prev = F.coalesce(F.col("_prev_in"), F.col("_prev_b"))
    gap = F.when(too_long(prev, F.col("first_date")), F.lit(None)).otherwise(F.col("first_date") - prev)
    session = F.col("_ofs") + F.col("_b_new") + F.col("_n_in")
    return out.select(
        *assigned.columns, gap.alias("time_since_prev_cs"), session.cast("long").alias("session")
    )


def sizes(sessions: DataFrame) -> DataFrame:
    """A5 + W3 + J12 from session rows that carry their changeset facts.

    One aggregation per session: span, raw labour hours, edit sums, and the
    first changeset's edits (``min_by`` replaces DISTINCT ON plus a join).
    """
    out = sessions.groupBy(*KEY, "session").agg(
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        *[F.sum(c).cast("long").alias(c) for c in FACTS],
        F.min_by("num_edits", F.struct(*ORDER)).alias("first_num_edits"),
        F.min_by("changeset", F.struct(*ORDER)).alias("first_changeset"),
    )
    return out.withColumn("labour_hours", hours_between("first_date", "last_date"))


def first_changesets(sessions: DataFrame) -> DataFrame:
    """The first changeset of each session and its edits."""
    return sizes(sessions).select(
        "session", F.col("first_changeset").alias("changeset"), F.col("first_num_edits").alias("num_edits")
    )


def rate(size: DataFrame) -> DataFrame:
    """A6 + P8: mean of labour_hours / num_edits over sessions with positive hours (one row)."""
    return size.where(F.col("labour_hours") > F.lit(0.0)).agg(
        F.avg(F.col("labour_hours") / F.col("num_edits")).alias("avg_lhpe")
    )


def labour(size: DataFrame) -> DataFrame:
    """Labour hours plus the global rate times the first changeset's edits.

    The rate is a scalar subquery: computed once, then a constant in the
    session projection. No session with positive hours makes it NULL, and with
    it every labour value, as in the reference.
    """
    avg_lhpe = rate(size).scalar()
    return size.select(
        *KEY, "session", "first_date", "last_date",
        (F.col("labour_hours") + avg_lhpe * F.col("first_num_edits")).alias("labour_hours"),
        *FACTS,
    )


__all__ = [
    "sessionize", "sizes", "first_changesets", "rate", "labour", "exclusive_prefix_sum",
]
