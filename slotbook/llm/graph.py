"""Connected components of a link table by alternating large-star and
small-star steps (each a group minimum and a join), written between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotbook.llm.common import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One step over (a, b) edges with a > b; returns such edges again."""
    both = edges if small else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = both.join(least, "a")
    if small:    # all smaller neighbours, and the node itself, hang on the least one
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(hung.select("a", F.col("m").alias("b")))
    else:        # larger neighbours hang on the least one
        out = hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): component is the least node reachable; nodes without links are absent.

    ``links`` has columns a and b (long).  A star is stable under both steps, so the
    rounds end when the edges stay the same; their number grows with the logarithm of the longest path.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a <> b").distinct(), "links")
    while True:
        after = written(_star(_star(edges, False), True), "links")
        # both tables hold distinct edges: equal in number and none new means equal
        if after.count() == edges.count() and after.join(edges, ["a", "b"], "left_anti").isEmpty():
            break
        edges = after
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
