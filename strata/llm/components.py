"""Connected components of a distributed edge list.

Alternating star contractions: a large-star step hangs every larger
neighbour of a node onto the node's smallest neighbour, a small-star step
does the same for the smaller ones. Both are one grouped minimum (combined
map-side) and one join, and keep components as they are; when nothing
changes, every node hangs on the smallest node of its component. A node with
many links is only ever a join key of a two-column table, whose partitions
adaptive execution can split. Each round is written to the shared folder, so
the lineage stays short. The driver sees one count and one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node with an edge to a smaller node:
    ``component`` is the smallest node it is linked to, directly or not. Nodes
    not listed are the smallest of their component (or have no edge)."""
    now = stored(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b").distinct(), "links"
    )
    seen = None
    while True:
        now = stored(_small_star(_large_star(now)), "links")
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if tuple(state) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = tuple(state)
