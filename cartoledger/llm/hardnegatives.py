"""Hard-negative mining over lists shared by clusters of anchors (MAXIMUS-style), exact.

Anchors of one label that point the same way form a cluster. The anchors are
laid out cluster by cluster and cut into stripes, all rows into blocks; a cell
is one stripe against one block, so no task holds more than both. In a cell,
each cluster sorts the block once by the largest inner product that any member
could have with a row (its angle to the cluster's center, less the cluster's
own half angle); every member walks that list and stops as soon as the bound of
the rest certifies that nothing better follows. A first pass finds the
positives, a second the negatives in the range of each positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartoledger.llm.vectors import integer_vectors, matrix, stored

# Directions that anchors are gathered around: at most so many anchors, those of least hash.
LEADERS = 64
# Numbers in a stripe of anchors and in a block of rows, at most (a row of 64 components is 64 numbers).
STRIPE_VALUES = 1 << 22
BLOCK_VALUES = 1 << 20
# Small tables are cut into more blocks than that, down to so many rows, so that all cores have work.
LEAST_BLOCK_ROWS = 1024
# Rows of a list looked at before the bound is asked first; doubled each time.
STEP = 128


def angular_bounds(rows: np.ndarray, center: np.ndarray, half_angle: float) -> np.ndarray:
    """Largest inner product of each row with a unit vector within ``half_angle`` of the unit vector ``center``."""
    lengths = np.sqrt((rows**2).sum(1))
    cosines = np.divide(rows @ center, lengths, out=np.zeros(len(rows)), where=lengths > 0)
    angles = np.arccos(np.clip(cosines, -1, 1))
    return lengths * np.cos(np.maximum(0, angles - half_angle - 1e-7))  # the slack covers the rounding of arccos


def center_of(members: np.ndarray) -> tuple[np.ndarray, float]:
    """Mean direction of the rows of ``members`` and the largest angle to it; rows of zeros have none."""
    lengths = np.sqrt((members**2).sum(1))
    units = members[lengths > 0] / lengths[lengths > 0][:, None]
    mean = units.sum(0)
    size = np.sqrt((mean**2).sum())
    if size < 1e-9:  # no direction to speak of: any unit vector, with the widest angle
        mean, size = np.eye(1, members.shape[1])[0], 1.0
        return mean, np.pi
    return mean / size, float(np.arccos(np.clip(units @ (mean / size), -1, 1)).max())


class Best:
    """The ``size`` best (score, id) met so far: higher scores first, ties by smaller id."""

    def __init__(self, size: int, low: float = -np.inf, high: float = np.inf):
        self.size, self.low, self.high = size, low, high
        self.scores = np.zeros(0)
        self.ids = np.zeros(0, np.int64)

    def floor(self) -> float:
        """No score under this is of use."""
        return max(self.low, self.scores[-1]) if len(self.scores) == self.size else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = (scores >= self.floor()) & (scores <= self.high)
        if not fit.any():
            return
        scores, ids = np.concatenate((self.scores, scores[fit])), np.concatenate((self.ids, ids[fit]))
        order = np.lexsort((ids, -scores))[: self.size]
        self.scores, self.ids = scores[order], ids[order]


def walk(
    members: np.ndarray, wanted: list[list[Best]], rows: np.ndarray, ids: np.ndarray, own: np.ndarray, keys: np.ndarray
) -> int:
    """Fill ``wanted`` (per member) from ``rows``; a row whose key is a member's own is passed over. Returns rows looked at."""
    center, half_angle = center_of(members)
    bounds = angular_bounds(rows, center, half_angle)
    order = np.argsort(-bounds, kind="stable")
    bounds, rows, ids, keys = bounds[order], rows[order], ids[order], keys[order]
    lengths = np.sqrt((members**2).sum(1))
    active = np.array([m for m, lists in enumerate(wanted) if lists], np.int64)
    at, step, looked = 0, STEP, 0
    while at < len(rows) and len(active):
        to = min(at + step, len(rows))
        scores = np.rint(members[active] @ rows[at:to].T)
        looked += scores.size
        # Nothing after ``to`` scores more than this with a member.
        rest = lengths[active] * max(bounds[to], 0) * (1 + 1e-9) + 1e-6 if to < len(rows) else None
        still = []
        for i, m in enumerate(active.tolist()):
            fair = keys[at:to] != own[m]
            line, names = scores[i][fair], ids[at:to][fair]
            for best in wanted[m]:
                best.add(line, names)
            if rest is not None and any(rest[i] >= best.floor() for best in wanted[m]):
                still.append(m)
        active = np.array(still, np.int64)
        at, step = to, step * 2
    return looked


def _layout(anchors: DataFrame, stripe_rows: int) -> DataFrame:
    """``anchors`` with ``cluster`` and ``stripe``: clusters in a row, cut every ``stripe_rows`` anchors.

    Leaders are the anchors of least hash (``LEADERS`` at most); an anchor joins the leader it is most alike.
    """
    leaders = anchors.orderBy(F.xxhash64("row"), "row").limit(LEADERS).select("q").collect()
    width = max((len(r["q"]) for r in leaders), default=0)
    units = np.zeros((len(leaders), width))
    for i, r in enumerate(leaders):
        units[i, : len(r["q"])] = r["q"]
    units /= np.maximum(np.sqrt((units**2).sum(1)), 1)[:, None]

    def join_leader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("q")
            lists = batch.column(at)
            longest = int(np.diff(lists.offsets.to_numpy()).max(initial=0))
            like = matrix(lists, max(longest, width))[:, :width] @ units.T
            cluster = like.argmax(1) if len(units) else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cluster.astype(np.int32))], names=[*batch.schema.names, "cluster"]
            )

    schema = T.StructType([*anchors.schema.fields, T.StructField("cluster", T.IntegerType())])
    spread = anchors.mapInArrow(join_leader, schema).repartitionByRange("label", "cluster", "row")
    # Place in the whole order: place in the partition plus the sizes of the partitions before (a number per partition).
    placed = spread.sortWithinPartitions("label", "cluster", "row").select(
        "*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_i")
    )
    placed = stored(placed, "anchors")
    sizes = sorted((r["_p"], r["n"]) for r in placed.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, before = [], 0
    for p, n in sizes:
        offsets.append((p, before))
        before += n
    table = F.broadcast(anchors.sparkSession.createDataFrame(offsets, "_p int, _before long"))
    place = F.floor((F.col("_i") + F.col("_before")) / stripe_rows)
    return placed.join(table, "_p").withColumn("stripe", place.cast("int")).drop("_p", "_i", "_before")


def _cells(anchors: DataFrame, rows: DataFrame, stripes: int, blocks: int, work, schema: str) -> DataFrame:
    """``work(anchors, rows)`` for every stripe against every block."""
    left = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn(
        "stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))
    )
    return left.groupBy("stripe", "block").cogroup(right.groupBy("stripe", "block")).applyInArrow(work, schema)


def _clusters(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple]:
    """Per cluster of a cell: indexes of its anchors, and all rows as (matrix, ids, keys, mask of its label)."""
    if not anchors.num_rows or not rows.num_rows:
        return
    lists = [t.column("q").combine_chunks() for t in (anchors, rows)]
    width = max(int(np.diff(x.offsets.to_numpy()).max()) for x in lists)
    vectors, every = (matrix(x, width) for x in lists)
    largest = max(np.abs(vectors).max(initial=0), np.abs(every).max(initial=0))
    if width * largest**2 >= 2**53:
        raise ValueError("components are too large for exact inner products")
    ids, keys = rows.column("vec_id").to_numpy(), rows.column("row").to_numpy()
    own = anchors.column("row").to_numpy()
    labels = rows.column("label").combine_chunks().dictionary_encode()
    of_row = labels.indices.to_numpy()
    number = {v: i for i, v in enumerate(labels.dictionary.to_pylist())}
    groups: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(anchors.column("label").to_pylist(), anchors.column("cluster").to_pylist(), strict=True)):
        groups.setdefault(key, []).append(i)
    for (label, _), at in groups.items():
        same = of_row == number.get(label, -1)
        yield np.array(at), vectors[at], own[at], every, ids, keys, same


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    nearest: tuple[int, int] = (80, 100),
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    stripe_values: int = STRIPE_VALUES,
    block_values: int = BLOCK_VALUES,
    least_block_rows: int = LEAST_BLOCK_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become ``floor(scale * x)``; a score is an integer inner product.
    Of an anchor's label, the ``positives`` best other rows are its positives; per
    positive, the ``negatives`` best rows of another label whose score lies between
    ``nearest[0] / nearest[1]`` of the positive's and the positive's own are
    returned. Higher scores come first, ties by smaller id. ``is_anchor`` is a
    condition on the column ``vec_id``.

    Rows with a null id, label or vector, or a null or non-finite component, take
    no part. Every other row stands for itself, repeated rows too: equal ids are
    each other's partners. Shorter vectors count as filled up with zeros. An empty
    table gives an empty result; other columns are dropped.
    """
    spark = vectors.sparkSession
    own = integer_vectors(vectors, scale, id_col, vec_col, label_col)
    own = own.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    rows = stored(own.withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("width")).first()
    width = max(size["width"] or 1, 1)
    anchors = _layout(rows.where(is_anchor), max(1, stripe_values // width))
    stripes = (anchors.agg(F.max("stripe").alias("s")).first()["s"] or 0) + 1
    spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), size["n"] // least_block_rows)
    blocks = max(1, -(-size["n"] // max(1, block_values // width)), spread)
    low, full = nearest

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for at, members, keys, every, ids, all_keys, same in _clusters(left, right):
            wanted = [[Best(positives)] for _ in at]
            walk(members, wanted, every[same], ids[same], keys, all_keys[same])
            for key, (best,) in zip(keys.tolist(), wanted, strict=True):
                out += [(key, i, int(s)) for i, s in zip(best.ids.tolist(), best.scores.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["row", "positive_id", "score"])

    found = _cells(anchors, rows, stripes, blocks, find_positives, "row long, positive_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "positive_id")
    found = found.withColumn("k", F.row_number().over(best)).where(F.col("k") <= positives)
    pairs = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", "positive_id", "score"))).alias("pos"))
    paired = stored(anchors.join(pairs, "row"), "anchors-positives")

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        pos = left.column("pos").to_pylist()
        for at, members, keys, every, ids, all_keys, same in _clusters(left, right):
            wanted = []
            for i in at.tolist():
                scores = sorted({p["score"] for p in pos[i]})
                # low * positive <= full * negative, in integers: the least fitting negative score
                ranges = [(-(-low * s // full), s) for s in scores]
                wanted.append([Best(negatives, a, b) for a, b in ranges if a <= b])
            walk(members, wanted, every[~same], ids[~same], keys, all_keys[~same])
            for i, key, lists in zip(at.tolist(), keys.tolist(), wanted, strict=True):
                by_score = {b.high: b for b in lists}
                for p in pos[i]:
                    b = by_score.get(p["score"])
                    if b is not None:
                        out += [
                            (key, p["k"], n, int(s)) for n, s in zip(b.ids.tolist(), b.scores.tolist(), strict=True)
                        ]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["row", "k", "negative_id", "negative_score"])

    near = _cells(paired, rows, stripes, blocks, find_negatives, "row long, k long, negative_id long, negative_score long")
    best = Window.partitionBy("row", "k").orderBy(F.desc("negative_score"), "negative_id")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    named = paired.select("row", F.col("vec_id").alias("anchor_id"), F.explode("pos").alias("p"))
    named = named.select("row", "anchor_id", F.col("p.k").cast("long").alias("k"), "p.positive_id", "p.score")
    return near.join(named, ["row", "k"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )
