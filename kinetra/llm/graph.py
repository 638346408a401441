"""Connected components of a graph whose nodes are 64-bit numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges (a, b): label is the smallest node of its component.

    Each round points every node at its smallest neighbour, follows two pointers further and contracts the
    graph along them; the edges left shrink at least by half of the nodes that still have some.  Every round is
    written to the shared folder.  Loops and repeated edges are harmless, no edge gives no row.
    """
    loops = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    edges = cut(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    mapping = cut(loops.select("node", F.col("node").alias("label")), "labels")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = cut(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up")), "parents")
        for _ in range(2):
            higher = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            parent = parent.join(higher, "up").select("node", F.col("top").alias("up"))
        parent = cut(parent, "parents")
        ends = [parent.select(F.col("node").alias(c), F.col("up").alias(f"up_{c}")) for c in ("a", "b")]
        edges = edges.join(ends[0], "a").join(ends[1], "b").filter("up_a != up_b")
        edges = cut(edges.select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct(), "edges")
        mapping = cut(mapping.join(parent.select(F.col("node").alias("label"), "up"), "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels")
    return mapping
