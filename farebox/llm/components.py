"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import stored


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One round: each node's neighbours (its larger ones in a large star, its
    smaller ones and itself in a small star) are linked to the smallest node
    that it knows. A hub's neighbours are joined to one minimum, never
    gathered."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if larger:
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        out = both.filter("b > a").join(least, "a").select("b", "m")
    else:
        down = both.filter("b < a")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        out = (down.join(least, "a").select("b", "m")
               .union(least.select(F.col("a").alias("b"), "m")))
    return (out.filter("b <> m").distinct()
            .select(F.col("m").alias("a"), F.col("b")))


def components(edges: DataFrame) -> DataFrame:
    """From undirected edges (a long, b long): (node, root) with ``root`` the
    smallest node of the component, for every node of an edge. Each round is
    written to the shared folder; rounds grow with the logarithm of the
    longest path. Self-loops and repeated edges are ignored."""
    now = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .filter("a < b").distinct(), "edges")
    seen = _digest(now)
    while seen[0]:
        now = stored(_star(_star(now, True), False), "edges")
        then, seen = seen, _digest(now)
        if then == seen:
            break
    roots = now.select("a").distinct()
    return (now.select(F.col("b").alias("node"), F.col("a").alias("root"))
            .union(roots.select(F.col("a").alias("node"), F.col("a").alias("root"))))
