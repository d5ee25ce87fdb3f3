"""Integer vectors from columns of floating-point vectors, and small helpers of the operators on them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartoledger.llm.common import name_checkpoint_dir

# Largest integer component: sums of squares of differences over 64 of them still fit a long.
LARGEST = 1 << 27


def integer_vectors(
    df: DataFrame, scale: int, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``(vec_id, label, q)`` of the rows whose vector is a list of finite numbers; ``q`` holds ``floor(scale * x)``.

    Rows with a null vector, or a null or non-finite component, are dropped.
    Null ids and labels, repeated rows and empty vectors are kept; other columns
    are dropped. A component beyond ``LARGEST`` after scaling is an error.
    """
    own = df.select(
        df[id_col].cast("long").alias("vec_id"),
        df[label_col].alias("label"),
        df[vec_col].cast("array<double>").alias("q"),
    )
    fields = [own.schema["vec_id"], own.schema["label"], T.StructField("q", T.ArrayType(T.IntegerType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            batch = batch.filter(lists.is_valid())
            lists = batch.column(2)
            if not len(lists):
                continue
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            offsets -= offsets[0]
            whole = np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64) * scale)  # a null comes as NaN
            fine = np.isfinite(whole)
            bad = np.concatenate(([0], np.cumsum(~fine)))
            good = bad[offsets[1:]] == bad[offsets[:-1]]
            lengths = np.diff(offsets)
            of_good = np.repeat(good, lengths)
            values = whole[of_good]
            if len(values) and np.abs(values).max() > LARGEST:
                raise ValueError(f"a vector component times {scale} is over {LARGEST}")
            starts = np.concatenate(([0], np.cumsum(lengths[good]))).astype(np.int32)
            kept = batch.filter(pa.array(good))
            q = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), q], names=["vec_id", "label", "q"])

    return own.mapInArrow(run, T.StructType(fields))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a float matrix, shorter ones filled up with zeros (all values are integers below 2**53)."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    if (lengths == width).all():
        return flat.reshape(len(lists), width).astype(np.float64)
    out = np.zeros((len(lists), width))
    out[np.repeat(np.arange(len(lists)), lengths), np.concatenate([np.arange(n) for n in lengths] or [lengths])] = flat
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: lineage ends there."""
    spark = df.sparkSession
    name_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
