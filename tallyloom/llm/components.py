"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.frames import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _hung(pairs: DataFrame) -> DataFrame:
    """Each node with its smallest neighbour or itself; map-side minima keep hot nodes cheap."""
    return pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def _ordered(edges: DataFrame) -> DataFrame:
    return (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    pairs = _both(edges)
    return _ordered(pairs.join(_hung(pairs), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.union(lowest.select("a", F.col("m").alias("b"))))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link, roots included; `links` has columns a and b.

    The root is the smallest id reachable. Rounds grow with the logarithm of the
    largest component. Each round is a written table; only a count and a checksum
    come to the driver. Null ends are ignored, repeated links and loops do no harm;
    a node whose only link is a loop is its own root.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).na.drop()
    links = written(links, "links")
    edges, mark = written(_ordered(links), "stars"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or tuple(now) == mark:
            break
        mark = tuple(now)
        edges = written(_small_star(_large_star(edges)), "stars")
    roots = edges.select("b").union(links.where("a = b").select("a")).distinct().select(F.col("b").alias("node"))
    own = roots.join(edges.select(F.col("a").alias("node")), "node", "left_anti")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        own.select("node", F.col("node").alias("root")))
