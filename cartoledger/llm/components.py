"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoledger.llm.common import checkpointed

MAX_ROUNDS = 60


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over undirected links ``(a, b)``.

    Each node joins its neighbours to the least node it sees: large-star moves
    the larger neighbours, small-star the smaller ones and the node itself.
    The least neighbour is a plain aggregate (partial sums before the shuffle)
    joined back, so a hub with very many links is split like any skewed join.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; root is the least node of its component.

    The links shrink to stars around the roots in a logarithmic number of
    rounds; each round is checkpointed. Self-links and repeated links are
    harmless, null ends are ignored, no link gives an empty result.
    """
    edges = checkpointed(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        edges = checkpointed(_stars(_stars(edges, True), False))
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
