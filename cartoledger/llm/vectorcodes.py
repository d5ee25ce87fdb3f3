"""Vector code compression: product codebooks fitted by Lloyd rounds over partition-local cover trees.

Vectors are cut into equal parts, each with its own codebook. Every task packs
its rows into blocks and builds one cover tree per part and block: balls whose
radius halves from level to level, over points in leaf order with cumulative
counts and sums. The trees are stored once. In a round a ball whose nearest
entry is nearer than the second by more than twice its radius goes to that
entry as a whole, by the triangle inequality, and adds its sums by one
subtraction; only the other balls descend, and only the points of ambiguous
smallest balls are compared exactly, in integers. Rounds send one row of sums
per entry and task; no vector is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartoledger.llm.vectors import integer_vectors, matrix, stored

# Rows per block; a block's pairwise distances are in memory while its tree is built.
BLOCK_ROWS = 2048
# Points of a ball that is not divided further.
LEAF = 8
# Labels with over this share of the rows are joined by broadcast: there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.01

_TREE = ("place", "points", "counts", "low", "high", "center", "parent", "radius")
_TREE_TYPE = T.StructType([T.StructField(c, T.BinaryType()) for c in _TREE])
_KINDS = {c: np.float64 if c == "radius" else np.int32 for c in _TREE}


@dataclass
class Tree:
    """Distinct points in leaf order, and balls over ranges of them, parents before children.

    ``place[row]`` is the point of a row, ``counts`` the rows of a point; ball
    ``b`` covers points ``low[b]:high[b]`` within ``radius[b]`` of point
    ``center[b]`` and is a child of ball ``parent[b]``.
    """

    place: np.ndarray
    points: np.ndarray
    counts: np.ndarray
    low: np.ndarray
    high: np.ndarray
    center: np.ndarray
    parent: np.ndarray
    radius: np.ndarray

    def pack(self) -> dict[str, bytes]:
        return {c: getattr(self, c).astype(_KINDS[c]).tobytes() for c in _TREE}

    @classmethod
    def unpack(cls, packed: dict[str, bytes], width: int) -> Tree:
        arrays = {c: np.frombuffer(packed[c], _KINDS[c]) for c in _TREE}
        arrays["points"] = arrays["points"].reshape(-1, width).astype(np.float64)
        return cls(**arrays)


def _exact(width: int, largest: float) -> None:
    if width * (2 * largest) ** 2 >= 2**53:
        raise ValueError("components are too large for exact squared distances")


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every entry; exact, as all values are integers below 2**53."""
    return (points**2).sum(1)[:, None] - 2 * (points @ entries.T) + (entries**2).sum(1)[None, :]


def build(vectors: np.ndarray) -> Tree:
    """Cover tree of the rows of an integer matrix (at least one row)."""
    _exact(vectors.shape[1], np.abs(vectors).max(initial=0))
    points, place, counts = np.unique(vectors, axis=0, return_inverse=True, return_counts=True)
    place = place.reshape(-1)
    apart = np.sqrt(squares(points, points))
    order: list[np.ndarray] = []
    done = 0
    low, high, center, parent, radius = [], [], [], [], []
    # (center, points it covers with itself first, parent ball); the children of a ball come off the stack before its siblings.
    todo = [(0, np.arange(len(points)), -1)]
    while todo:
        c, members, above = todo.pop()
        reach = apart[c, members]
        ball, widest = len(low), float(reach.max())
        low.append(done)
        center.append(c)
        parent.append(above)
        radius.append(widest)
        high.append(done + len(members))
        if len(members) <= LEAF or widest == 0:
            order.append(members)
            done += len(members)
            continue
        # Half the reach round the center, then round points that no child covers yet: children lie over half apart.
        parts = [(c, members[reach <= widest / 2], ball)]
        left = members[reach > widest / 2]
        while len(left):
            near = apart[left[0], left] <= widest / 2
            parts.append((left[0], left[near], ball))
            left = left[~near]
        todo.extend(reversed(parts))
    leaf_order = np.concatenate(order)
    where = np.empty(len(points), np.int64)
    where[leaf_order] = np.arange(len(points))
    arrays = [np.array(a, np.int64) for a in (low, high, center, parent)]
    return Tree(
        where[place], points[leaf_order], counts[leaf_order], arrays[0], arrays[1], where[arrays[2]], arrays[3],
        np.array(radius),
    )


def assign(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(balls, entry per ball)`` decided whole, then ``(points, entry per point)`` compared exactly, as two arrays of pairs."""
    children = np.argsort(tree.parent, kind="stable")
    starts = np.searchsorted(tree.parent[children], np.arange(len(tree.low) + 1))
    whole, single = [], []
    front = np.array([0])
    while len(front):
        distance = np.sqrt(np.maximum(squares(tree.points[tree.center[front]], entries), 0))
        nearest = distance.argmin(1)
        first = distance[np.arange(len(front)), nearest]
        if len(entries) > 1:
            second = np.partition(distance, 1, axis=1)[:, 1]
        else:
            second = np.full(len(front), np.inf)
        reach = tree.radius[front]
        # Strictly nearer for every point of the ball, with room for rounding; equal entries are never decided here.
        sure = first + reach + 1e-9 * (1 + first + reach) < second - reach
        whole.append(np.stack([front[sure], nearest[sure]], 1))
        open_ = front[~sure]
        counts = starts[open_ + 1] - starts[open_]
        leaves = open_[counts == 0]
        if len(leaves):
            spans = tree.high[leaves] - tree.low[leaves]
            single.append(np.repeat(tree.low[leaves] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum()))
        inner, counts = open_[counts > 0], counts[counts > 0]
        at = np.repeat(starts[inner] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        front = children[at]
    points = np.concatenate(single) if single else np.zeros(0, np.int64)
    nearest = squares(tree.points[points], entries).argmin(1)  # ties: the lower index
    return np.concatenate(whole), np.stack([points, nearest], 1)


def sums(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and component sums per entry."""
    balls, points = assign(tree, entries)
    weight = tree.counts.astype(np.int64)
    weighted = tree.points.astype(np.int64) * weight[:, None]
    running = np.concatenate((np.zeros((1, weighted.shape[1]), np.int64), np.cumsum(weighted, 0)))
    so_far = np.concatenate(([0], np.cumsum(weight)))
    n, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    low, high = tree.low[balls[:, 0]], tree.high[balls[:, 0]]
    np.add.at(n, balls[:, 1], so_far[high] - so_far[low])
    np.add.at(total, balls[:, 1], running[high] - running[low])
    np.add.at(n, points[:, 1], weight[points[:, 0]])
    np.add.at(total, points[:, 1], weighted[points[:, 0]])
    return n, total


def codes(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every row."""
    balls, points = assign(tree, entries)
    own = np.empty(len(tree.points), np.int64)
    for ball, entry in balls.tolist():
        own[tree.low[ball] : tree.high[ball]] = entry
    own[points[:, 0]] = points[:, 1]
    error = ((tree.points - entries[own]) ** 2).sum(1).astype(np.int64)
    return own[tree.place], error[tree.place]


def trees(vectors: DataFrame, parts: int, width: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(ids, labels, trees)``: blocks of the rows of ``vectors(vec_id, label, q)`` with a tree per part."""
    label = vectors.schema["label"].dataType
    schema = T.StructType(
        [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(label))]
        + [T.StructField("trees", T.ArrayType(_TREE_TYPE))]
    )
    packed = pa.list_(pa.struct([pa.field(c, pa.binary()) for c in _TREE]))

    def block(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        q = matrix(table.column("q").combine_chunks(), parts * width)
        own = [build(q[:, p * width : (p + 1) * width]).pack() for p in range(parts)]
        ends = pa.array([0, table.num_rows], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, table.column(c).combine_chunks()) for c in ("vec_id", "label")]
        return pa.RecordBatch.from_arrays([*lists, pa.array([own], packed)], names=["ids", "labels", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, block_rows - rows)
                waiting.append(taken)
                rows += taken.num_rows
                batch = batch.slice(taken.num_rows)
                if rows == block_rows:
                    yield block(pa.Table.from_batches(waiting))
                    waiting, rows = [], 0
        if rows:
            yield block(pa.Table.from_batches(waiting))

    return vectors.mapInArrow(run, schema)


def _each(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[Tree]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1), [Tree.unpack(t, width) for t in batch.column("trees")[i].as_py()]


def lloyd_round(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks after one round: componentwise floor of the mean of an entry's parts; unused entries stay."""
    width = books[0].shape[1]
    names = ["part", "entry", "n", *[f"s{j}" for j in range(width)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(books), len(books[0])), np.int64)
        total = np.zeros((len(books), *books[0].shape), np.int64)
        for _, own in _each(batches, width):
            for p, tree in enumerate(own):
                more, added = sums(tree, books[p])
                n[p] += more
                total[p] += added
        used = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (*used, n[used], *total[used].T)], names=names
        )

    found = blocks.mapInArrow(run, ", ".join(f"{c} long" for c in names))
    rows = found.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in names[2:]]).collect()  # parts x entries at most
    out = [book.copy() for book in books]
    for r in rows:
        out[r["part"]][r["entry"]] = [r[c] // r["n"] for c in names[3:]]
    return out


def coded(blocks: DataFrame, books: list[np.ndarray], label_type: T.DataType) -> DataFrame:
    """``(vec_id, label, codes, error)``: entry per part, and the squared distances summed over parts."""
    width = books[0].shape[1]
    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("label", label_type)]
        + [T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, own in _each(batches, width):
            found = [codes(tree, book) for tree, book in zip(own, books, strict=True)]
            all_codes = np.stack([c for c, _ in found], 1).astype(np.int32)
            ends = np.arange(0, all_codes.size + 1, len(books), dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(all_codes.reshape(-1)))
            error = pa.array(sum(e for _, e in found))
            columns = [row.column("ids").flatten(), row.column("labels").flatten(), lists, error]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "codes", "error"])

    return blocks.mapInArrow(run, schema)


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` and ``label_error``, the sum of ``error`` over rows of the same label (nulls together).

    Sums combine before the shuffle. Labels with over ``HOT_SHARE`` of the rows
    (so at most a hundred) meet their rows by broadcast, the others by a join on the label.
    """
    total = rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n"))
    limit = max(1, int(rows.count() * HOT_SHARE))
    hot = F.broadcast(total.where(F.col("_n") > limit).select(F.col("label").alias("_l"), "label_error"))
    cold = total.where(F.col("_n") <= limit).select(F.col("label").alias("_l"), "label_error")
    same = F.col("label").eqNullSafe(F.col("_l"))
    of_hot = rows.join(hot, same).drop("_l")
    return of_hot.unionByName(rows.join(hot, same, "left_anti").join(cold, same).drop("_l"))


@dataclass
class Compressed:
    """``rows``: vec_id, label, codes, error, label_error; ``books``: one integer matrix per part."""

    rows: DataFrame
    books: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all entries' components as decimal integers, by part, entry and position, joined by commas."""
        values = (str(int(v)) for book in self.books for v in book.reshape(-1))
        return hashlib.sha256(",".join(values).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> Compressed:
    """Codebooks after ``rounds`` Lloyd rounds over all rows, and every row's codes under them.

    Components become ``floor(scale * x)``. The codebooks start as the parts of
    the ``entries`` rows of smallest id (ties: smaller vector; null ids last).
    Rows with a null vector or a null or non-finite component are dropped, and so
    are rows whose vector has another length than that of the smallest id or no
    component. That length must be divisible by ``parts``. Repeated rows count as
    often as they occur and get equal codes. No kept row: an empty result and no
    codebooks. Columns other than the three named are dropped.
    """
    own = integer_vectors(vectors, scale, id_col, vec_col, label_col).where(F.size("q") > 0)
    order: list[Column] = [F.col("vec_id").asc_nulls_last(), F.col("q")]
    first = own.orderBy(*order).limit(entries).collect()
    label = own.schema["label"].dataType
    if not first:
        schema = T.StructType(
            [T.StructField("vec_id", T.LongType()), T.StructField("label", label)]
            + [T.StructField("codes", T.ArrayType(T.IntegerType()))]
            + [T.StructField(c, T.LongType()) for c in ("error", "label_error")]
        )
        return Compressed(vectors.sparkSession.createDataFrame([], schema), [])
    length = len(first[0]["q"])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    own = own.where(F.size("q") == length)
    if any(len(r["q"]) != length for r in first):
        first = own.orderBy(*order).limit(entries).collect()
    width = length // parts
    seeds = np.array([r["q"] for r in first], np.float64)
    books = [seeds[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    blocks = stored(trees(own, parts, width, block_rows), "vector-trees")
    for _ in range(rounds):
        books = lloyd_round(blocks, books)
    rows = stored(coded(blocks, books, label), "vector-codes")
    return Compressed(with_label_error(rows), books)
