"""SimHash near-duplicate detection over a byte-position index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in
at most ``d`` bits differ in at most ``d`` bytes, so they share at least
``8 - d`` positional bytes. The inverted index is keyed by groups of positional
bytes, chosen so that any pair with enough shared bytes meets in at least one
list (single bytes would have lists of N/256 entries, whose pairs grow with
the square of N). A pair that meets is tallied (its shared positional bytes are
counted), kept if the tally reaches the guaranteed minimum, then verified by
its differing bits.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoledger.llm.common import checkpointed, pieces, text_of
from cartoledger.llm.components import components

BYTES = 8
GROUP = 4
# Members of one index list beyond which its links are found by shared neighbour points, not by pairs.
PAIR_LIST = 512


def fingerprint(data: bytes, size: int = 3, seed: int = 42) -> int:
    """SimHash of the lower-cased text's ``size``-word shingles (repeats count); no word: zero."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    spans = zip(starts[:n].tolist(), ends[min(size, len(words)) - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):  # bounded memory for very long texts
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame,
    size: int = 3,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_key: Column | None = None,
) -> DataFrame:
    """``(doc_id, fp)``, one row per row of ``docs``; ``fp`` holds the 64 bits as a signed long.

    With ``row_key``, a long, the rows carry it as ``key``.
    """
    names = ["doc_id", "fp"] if row_key is None else ["doc_id", "key", "fp"]
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            bits = np.array([fingerprint(t, size, seed) for t in batch.column("text").to_pylist()], np.uint64)
            own = [batch.column(c) for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*own, pa.array(bits.view(np.int64))], schema=schema)

    if row_key is None:
        own = text_of(docs, id_col, text_col)
    else:
        text = F.coalesce(docs[text_col].cast("binary"), F.lit(b""))
        own = docs.select(docs[id_col].cast("long").alias("doc_id"), row_key.alias("key"), text.alias("text"))
    return own.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def byte_groups(shared: int, group: int = GROUP) -> list[tuple[int, ...]]:
    """Groups of ``group`` byte positions such that every ``shared`` positions contain one of them (greedy cover)."""
    left = {frozenset(c) for c in itertools.combinations(range(BYTES), shared)}
    options = [frozenset(c) for c in itertools.combinations(range(BYTES), group)]
    chosen = []
    while left:
        best = max(options, key=lambda g: sum(g <= s for s in left))
        chosen.append(tuple(sorted(best)))
        left = {s for s in left if not best <= s}
    return chosen


def _byte(x: Column, at: int) -> Column:
    return F.shiftrightunsigned(x, 8 * at).bitwiseAND(F.lit(255))


def _flips(bits: list[int], radius: int) -> list[int]:
    """Signed 64-bit masks with at most ``radius`` of ``bits`` set."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in itertools.combinations(bits, r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, distance: int = 3, pair_list: int = PAIR_LIST) -> DataFrame:
    """``(a, b)`` links whose components are those of all pairs of ``fps(fp)`` within ``distance`` bits.

    ``fps`` must be distinct. Lists of the index with up to ``pair_list``
    members are joined with themselves. A longer list would give a square
    number of pairs; there, two members are within ``d`` bits exactly if the
    points within ``d // 2`` bits of one and within ``d - d // 2`` bits of the
    other meet, so each meeting point links all its members to the least
    member near it: rows grow with the members, none is left out.
    """
    shared = BYTES - distance
    if not 1 <= shared <= BYTES:
        raise ValueError("distance must lie between 0 and 7")
    groups = byte_groups(shared, min(GROUP, shared))
    keys = []
    for g, positions in enumerate(groups):
        key = F.lit(0).cast("long")
        for at in positions:
            key = F.shiftleft(key, 8).bitwiseOR(_byte(F.col("fp"), at))
        keys.append(F.struct(F.lit(g).alias("g"), key.alias("k")))
    index = fps.select("fp", F.explode(F.array(*keys)).alias("e")).select("fp", "e.g", "e.k")
    sizes = index.groupBy("g", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    index = checkpointed(index.join(sizes, ["g", "k"]))

    short = index.where(F.col("n") <= pair_list).select("g", "k", "fp")
    x, y = short.alias("x"), short.alias("y")
    differ = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    tally = sum(((_byte(differ, at) == 0).cast("int") for at in range(1, BYTES)), (_byte(differ, 0) == 0).cast("int"))
    pairs = x.join(
        y,
        (F.col("x.g") == F.col("y.g"))
        & (F.col("x.k") == F.col("y.k"))
        & (F.col("x.fp") < F.col("y.fp"))
        & (tally >= shared)
        & (F.bit_count(differ) <= distance),
    ).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))

    pairs = pairs.distinct()
    long = index.where(F.col("n") > pair_list).select("g", "k", "fp")
    if not long.head(1):
        return pairs
    near, far = distance // 2, distance - distance // 2

    def points(radius: int) -> DataFrame:
        masks = F.lit(None)
        for g, positions in enumerate(groups):
            free = [8 * p + b for p in range(BYTES) if p not in positions for b in range(8)]
            own = F.array(*[F.lit(m).cast("long") for m in _flips(free, radius)])
            masks = F.when(F.col("g") == g, own).otherwise(masks)
        return long.select("g", "k", "fp", F.explode(masks).alias("m")).select(
            "g", "k", "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("point")
        )

    inner = points(near)
    heads = inner.groupBy("g", "k", "point").agg(F.min("fp").alias("head"))
    stars = points(far).join(heads, ["g", "k", "point"]).select(F.col("fp").alias("a"), F.col("head").alias("b"))
    return pairs.union(stars.where("a <> b").distinct())


def near_duplicates(
    docs: DataFrame,
    size: int = 3,
    distance: int = 3,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    pair_list: int = PAIR_LIST,
) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``.

    Fingerprints link at ``distance`` or fewer differing bits; component_id is
    the least doc_id reachable, itself included. Only distinct fingerprints are
    compared, so any number of exact copies costs one entry. Empty and null
    texts have fingerprint zero and link like any other; null ids take part
    but never name a component unless nothing else is there.
    """
    marked = checkpointed(fingerprints(docs, size, seed, id_col, text_col))
    rooted = _rooted(marked, distance, pair_list)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def _rooted(marked: DataFrame, distance: int, pair_list: int) -> DataFrame:
    """``(fp, first, root)`` per distinct fingerprint of ``marked``: its least id and its component."""
    firsts = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(firsts.select("fp"), distance, pair_list)).withColumnRenamed("node", "fp")
    return firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def keep_first(
    docs: DataFrame, size: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component: rows of ``docs``, all columns unchanged.

    The row of the least id stays; rows without an id come last, and rows of
    equal id are told apart by a hash of all their columns, so every component
    keeps one document whatever ids repeat or are null. Rows equal in every
    column are one document and stay or go together.
    """
    key = F.xxhash64(*docs.columns)
    marked = checkpointed(fingerprints(docs, size, 42, id_col, text_col, key))
    roots = _rooted(marked, distance, PAIR_LIST).select("fp", "root")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    rows = marked.join(roots, "fp").select("root", "doc_id", "key").distinct()
    best = rows.groupBy("root").agg(F.min(place).alias("best"))
    gone = rows.join(best, "root").where(~place.eqNullSafe(F.col("best")))
    gone = gone.select(F.col("doc_id").alias("i"), F.col("key").alias("k"))
    same = docs[id_col].cast("long").eqNullSafe(F.col("i")) & (key == F.col("k"))
    return docs.join(gone, same, "left_anti")
