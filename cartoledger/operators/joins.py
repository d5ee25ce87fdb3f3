"""Join helpers: broadcast only behind a measured size bound.

``bounded_broadcast`` measures the small side with one partially aggregated
pass (each task sends a single row: row count and bytes) and marks it for
broadcast if both are within bounds. Beyond them the plain DataFrame is
returned: the join then shuffles on its keys. ``spread`` deals the rows of
measured heavy keys of such a join to several tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds below which a side is broadcast. The project-side tables have one
# row per (project, contributor) or per project; a few million small rows are
# tens of megabytes on the wire.
DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64_000_000
# For sides that carry arrays of edges, bound the total number of edges instead:
# four doubles and a polygon number take 56 bytes each in Spark's rows, so this is 56 MB.
DEFAULT_MAX_ELEMENTS = 1_000_000
# Keys with over this share of the rows of a shuffled side are dealt to several tasks; at most 1 / HEAVY_SHARE of them.
HEAVY_SHARE = 0.002


def row_bytes(df: DataFrame) -> Column:
    """About the size of a row on the wire: 8 bytes per column plus the length of its texts."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return reduce(lambda a, b: a + b, texts, F.lit(8 * len(df.columns))).cast("long")


def fits_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether ``df`` is within ``max_rows`` and ``max_bytes``; runs one partially aggregated pass."""
    max_rows = DEFAULT_MAX_ROWS if max_rows is None else max_rows
    max_bytes = DEFAULT_MAX_BYTES if max_bytes is None else max_bytes
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return size["n"] <= max_rows and size["b"] <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` if ``df`` is within ``max_rows`` and ``max_bytes``, else ``df`` unchanged (shuffle join)."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def spread(big: DataFrame, small: DataFrame, key: str, share: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``key`` with a column ``_salt`` to join on as well, so that heavy keys meet in many tasks.

    Keys with over ``share`` of the rows of ``big`` are measured (at most
    ``1 / share`` of them, so they may be collected and broadcast). Their rows
    get a salt by hash, one for each ``share`` they hold, and the rows of
    ``small`` with these keys are repeated once per salt; all others have salt 0.
    """
    share = HEAVY_SHARE if share is None else share
    part = max(1.0, big.count() * share)
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part)
    heavy = counts.select(F.col(key).alias("_k"), F.ceil(F.col("_n") / part).cast("int").alias("_salts")).collect()
    if not heavy:
        return big.withColumn("_salt", F.lit(0)), small.withColumn("_salt", F.lit(0))
    table = big.sparkSession.createDataFrame(heavy, f"_k {big.schema[key].dataType.simpleString()}, _salts int")

    def marked(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(table), df[key] == F.col("_k"), "left")

    salt = F.coalesce(F.pmod(F.xxhash64(*big.columns), F.col("_salts")).cast("int"), F.lit(0))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    return (
        marked(big).select(*[big[c] for c in big.columns], salt.alias("_salt")),
        marked(small).select(*[small[c] for c in small.columns], copies.alias("_salt")),
    )


def bounded_broadcast_by(
    df: DataFrame, weight: Column, max_total: int | None = None, known_total: int | None = None
) -> DataFrame:
    """Broadcast when the sum of ``weight`` over all rows (e.g. edges per region) is within ``max_total``.

    ``known_total`` is that sum when it was already measured (for example while the
    table was stored); then no job runs here.
    """
    max_total = DEFAULT_MAX_ELEMENTS if max_total is None else max_total
    if known_total is not None:
        total = known_total
    else:
        total = df.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("w")).first()["w"]
    return F.broadcast(df) if total <= max_total else df
