"""Helpers shared by the training-data operators: word splitting, n-gram hashes, staging."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Odd multiplier of the polynomial n-gram hashes (2**64 / golden ratio).
BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, so that order by value is as good as random."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    """64-bit hash of each word."""
    if seed:
        return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Rolling hash of every run of ``n`` word hashes (one value per start), by doubling the run length.

    ``H_n[i] = sum(hashes[i + j] * BASE**(n - 1 - j))`` modulo 2**64.
    """
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    size = len(hashes) - n + 1
    out, have, part, length = None, 0, hashes, 1
    power = BASE
    bits = n
    while bits:
        if bits & 1:
            # append the block that starts after the ``have`` words already covered
            block = part[have : have + size]
            out = block.copy() if out is None else out * power + block
            have += length
        bits >>= 1
        if bits:
            part = part[:-length] * power + part[length:]
            power = np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
            length *= 2
    return out


def name_checkpoint_dir(spark: SparkSession) -> None:
    """Give the SparkContext the checkpoint folder the session names; only a session without one gets a scratch folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
            named = tempfile.mkdtemp(prefix="llm-checkpoints-")
        sc.setCheckpointDir(named)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder (survives lost executors)."""
    name_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def pieces(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` at most (one row may hold more)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        at = batch.schema.get_field_index(column)
        values = batch.column(at)
        lengths = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(lengths):
            if i > start and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        yield batch.slice(start)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a variant that no column of ``df`` uses."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id long, text binary)`` of a document table; a null text is empty, other columns are dropped."""
    return df.select(
        df[id_col].cast("long").alias("doc_id"),
        F.coalesce(df[text_col].cast("binary"), F.lit(b"")).alias("text"),
    )
