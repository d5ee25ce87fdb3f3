"""Substring deduplication by seed and extend.

Seeds are winnowed: of every window of ``min_words`` words, the seed is the
least scrambled hash among its ``SEED_WORDS``-word runs, so equal windows
always carry the same seed and neighbouring windows mostly share one. Seeds of
two or more documents are found first; only these are extended to the windows
on both sides that carry them, and documents meet on (seed, window). Overlapping
matched windows grow together to maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cartoledger.llm.common import checkpointed, mix64, ngram_hashes, pieces, text_of, word_hashes

# Bits of the sketch of shared seeds: a table of fixed size (8 MB) at any scale.
SKETCH_BITS = 26

SEED_WORDS = 4
# Documents of one seed beyond which its windows are dealt to several tasks.
HOT_SEED = 200_000
_SEED = 7


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Sliding minimum over ``width`` values, by doubling."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(values) - width + 1], out[width - have :])
    return out


def window_seeds(hashes: np.ndarray, min_words: int) -> np.ndarray:
    """The seed of each window of ``min_words`` words."""
    if len(hashes) < min_words:
        return np.zeros(0, np.uint64)
    k = min(SEED_WORDS, min_words)
    return _least(mix64(ngram_hashes(hashes, k)), min_words - k + 1)


def window_hashes(hashes: np.ndarray, min_words: int) -> np.ndarray:
    """Hash of each window of ``min_words`` words; with its seed it identifies the window by 128 bits."""
    return mix64(ngram_hashes(hashes, min_words))


def _seed_rows(docs: DataFrame, min_words: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("seed", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            ids, seeds = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = np.unique(window_seeds(word_hashes(text.split(), _SEED), min_words))
                ids.append(np.full(len(own), doc_id, np.int64))
                seeds.append(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids)), pa.array(np.concatenate(seeds).view(np.int64))], schema=schema
            )

    return docs.mapInArrow(run, "doc_id long, seed long")


def _sketch(shared: DataFrame) -> np.ndarray:
    """Bitmap of the shared seeds by their low bits; its size is fixed, so it may be sent to all executors."""
    words = (
        shared.select(F.col("seed").bitwiseAND(F.lit((1 << SKETCH_BITS) - 1)).alias("b"))
        .selectExpr("cast(shiftright(b, 5) as int) w", "shiftleft(1L, cast(b & 31 as int)) m")
        .groupBy("w")
        .agg(F.bit_or("m").alias("m"))
        .toArrow()
    )
    out = np.zeros(1 << (SKETCH_BITS - 5), np.uint32)
    out[words.column("w").to_numpy()] = words.column("m").to_numpy().astype(np.uint32)
    return out


def _extend(docs: DataFrame, sketch: np.ndarray, hot: dict[int, int], min_words: int) -> DataFrame:
    """``(seed, splits, doc_id, windows)``: the distinct windows of each document around its seeds.

    Seeds that the sketch rules out are shared with no other document and are
    passed over; the few it lets through by chance find no partner later.
    """
    schema = pa.schema(
        [("seed", pa.int64()), ("splits", pa.int32()), ("doc_id", pa.int64()), ("windows", pa.list_(pa.int64()))]
    )
    sent = docs.sparkSession.sparkContext.broadcast((sketch, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, busy = sent.value
        for batch in pieces(batches, "text"):
            seeds, splits, ids, counts, found = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                hashes = word_hashes(text.split(), _SEED)
                own = window_seeds(hashes, min_words)
                place = own & np.uint64((1 << SKETCH_BITS) - 1)
                hit = (bits[place >> np.uint64(5)] >> (place & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0
                if not hit.any():
                    continue
                windows = np.stack([own[hit], window_hashes(hashes, min_words)[hit]], axis=1).view(np.int64)
                windows = windows[np.lexsort((windows[:, 1], windows[:, 0]))]
                fresh = np.concatenate(([True], (windows[1:] != windows[:-1]).any(axis=1)))
                windows = windows[fresh]
                first = np.flatnonzero(np.concatenate(([True], windows[1:, 0] != windows[:-1, 0])))
                part = windows[first, 0]
                seeds.append(part)
                splits.append(np.array([busy.get(x, 1) for x in part.tolist()] if busy else np.ones(len(part)), np.int32))
                ids.append(np.full(len(part), doc_id, np.int64))
                counts.append(np.diff(np.concatenate((first, [len(windows)]))))
                found.append(windows[:, 1])
            if seeds:
                offsets = np.concatenate(([0], np.cumsum(np.concatenate(counts)))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                flat = [pa.array(np.concatenate(c)) for c in (seeds, splits, ids)]
                yield pa.RecordBatch.from_arrays([*flat, lists], schema=schema)

    return docs.mapInArrow(run, "seed long, splits int, doc_id long, windows array<long>")


def _later(rows: DataFrame, hot: bool) -> DataFrame:
    """``(doc_id, window)`` of the windows that a smaller doc_id has too.

    Rows are dealt by seed before their windows are spread out: the seed
    travels once for all windows that carry it.
    """
    window = F.explode("windows").alias("window")
    if not hot:
        each = rows.repartition("seed").select("seed", "doc_id", window)
        least = F.min("doc_id").over(Window.partitionBy("seed", "window"))
        return each.withColumn("least", least).where("doc_id > least").select("doc_id", "window")
    # A hot seed is dealt to several tasks: each settles all but its least document,
    # and one row per task and window meets again.
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("splits"))).repartition("seed", "salt")
    dealt = salted.select("seed", "salt", "splits", "doc_id", window)
    dealt = dealt.withColumn("least", F.min("doc_id").over(Window.partitionBy("seed", "salt", "window")))
    heads = dealt.where("doc_id = least and splits > 1").select("seed", "window", "doc_id")
    least = F.min("doc_id").over(Window.partitionBy("seed", "window"))
    return (
        dealt.where("doc_id > least")
        .select("doc_id", "window")
        .union(heads.withColumn("least", least).where("doc_id > least").select("doc_id", "window"))
    )


def repeated_windows(docs: DataFrame, min_words: int = 13, hot_seed: int = HOT_SEED) -> DataFrame:
    """``(doc_id, windows)``: per document the hashes of its windows that also start in a smaller doc_id.

    ``docs`` has ``doc_id`` (not null) and ``text`` (binary, not null).
    """
    seeds = _seed_rows(docs, min_words)
    # Seeds of two or more documents: a plain aggregate, combined before the shuffle.
    shared = (
        seeds.groupBy("seed")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low < high")
        .select("seed", F.ceil(F.col("n") / hot_seed).cast("int").alias("splits"))
    )
    shared = checkpointed(shared)
    sketch = _sketch(shared)
    # At most (rows of seeds) / hot_seed entries.
    hot = {r["seed"]: r["splits"] for r in shared.where("splits > 1").collect()}
    return (
        _later(_extend(docs, sketch, hot, min_words), bool(hot))
        .groupBy("doc_id")
        .agg(F.collect_set("window").alias("windows"))
    )


def covered(hashes: np.ndarray, windows: np.ndarray, min_words: int) -> np.ndarray:
    """Mask of the words inside any of the given windows: the union is made of maximal repeats."""
    n = len(hashes)
    if not len(windows) or n < min_words:
        return np.zeros(n, bool)
    own = window_hashes(hashes, min_words).view(np.int64)
    hit = np.isin(own, windows).astype(np.int32)
    steps = np.zeros(n + 1, np.int32)
    steps[: len(own)] += hit
    steps[min_words : min_words + len(own)] -= hit
    return np.cumsum(steps[:-1]) > 0


def remove_repeats(
    docs: DataFrame,
    min_words: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    hot_seed: int = HOT_SEED,
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept, spans)``, one row per row of ``docs``.

    ``spans`` lists the maximal repeats removed as ``(start, end)`` word
    positions, ``kept`` is the remaining words joined by one space. A word is
    removed if a window of ``min_words`` words over it also starts in a
    document of smaller id; windows are judged on the input. Texts of fewer
    words, null and empty texts lose nothing; repeats inside one document or
    between rows of one id do not count (rows that share an id are one
    document); rows with a null id lose nothing and
    cost others nothing.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
        + [("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4_000_000):
            out = []
            for doc_id, text, windows in zip(*(batch.column(c) for c in ("doc_id", "text", "windows")), strict=True):
                words = text.as_py().split()
                gone = None
                if windows.is_valid:
                    gone = covered(word_hashes(words, _SEED), windows.values.to_numpy(), min_words)
                if gone is None or not gone.any():
                    kept, spans, removed = b" ".join(words), [], 0
                else:
                    kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
                    spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                    removed = int(gone.sum())
                out.append((doc_id.as_py(), len(words), removed, hashlib.sha256(kept).hexdigest(), kept, spans))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, schema.field(i).type) for i, c in enumerate(zip(*out, strict=True))], schema=schema
            )

    plain = text_of(docs, id_col, text_col)
    known = plain.where("doc_id is not null")
    joined = known.join(repeated_windows(known, min_words, hot_seed), "doc_id", "left").select("doc_id", "text", "windows")
    rest = plain.where("doc_id is null").withColumn("windows", F.lit(None).cast("array<long>"))
    return joined.union(rest).mapInArrow(
        run,
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary, "
        "spans array<struct<start: int, end: int>>",
    )
