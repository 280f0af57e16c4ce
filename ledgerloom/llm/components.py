"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b). Large: the larger neighbours of a node move to the least
    node around it. Small: a node and its smaller neighbours move there."""
    if large:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = near.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = least.where("m < a").select("a", F.col("m").alias("b"))
        out = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(own)
    return out.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to (node, root), root being the least node reachable; one row per node that has
    an edge. Nodes are of any orderable type. Loops and repeated edges do no harm.

    Each round is written to the shared folder, so that the lineage stays short and a lost executor
    costs one round at most. Only a count and a checksum reach the driver. The number of rounds
    grows with the square of the logarithm of the longest path.
    """
    kind = edges.schema["a"].dataType
    current = staged(edges.where("a <> b").select("a", F.col("b").cast(kind)).distinct(), "edges")
    state = _state(current)
    while state[0]:
        current = staged(_stars(_stars(current, True), False), "stars")
        last, state = state, _state(current)
        if state == last:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
