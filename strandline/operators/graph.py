"""Connected components and path compression of edge tables, by rounds whose number grows with the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage


def _starred(both: DataFrame) -> DataFrame:
    """Rows (u, v, m): m is the smallest of u and its neighbours."""
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """From rows (a, b) of any one orderable type: (node, root) of every node with an edge to another; root is the smallest node reachable.

    Alternating large-star and small-star steps; each round is written to the shared checkpoint folder.
    Minima are taken before rows meet, so a node with very many edges is no hot spot.
    """
    edges = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    said = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _starred(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = cut_lineage(small.filter("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == said:
            break
        said = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(edges.select(F.col("b"), F.col("b"))).distinct()


def compressed_paths(edges: DataFrame) -> DataFrame:
    """Unbranched paths of a directed graph (a, b): (node, path, place). A node follows its predecessor on a path if it is the only successor of the only predecessor. Pointer jumping; cycles without a branch start at their smallest node."""
    edges = edges.select("a", "b").distinct()
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    single_out = edges.groupBy("a").agg(F.count("*").alias("n"), F.first("b").alias("b")).filter("n = 1 and a <> b").select("a", "b")
    single_in = edges.groupBy("b").agg(F.count("*").alias("n")).filter("n = 1").select("b")
    links = cut_lineage(single_out.join(single_in, "b", "left_semi").select("a", "b"))
    # cut each unbranched cycle before its smallest node
    found = cut_lineage(components(links))
    whole = found.join(links.select(F.col("b").alias("node")), "node", "left_semi")
    sizes = found.groupBy("root").agg(F.count("*").alias("n"))
    cycles = whole.groupBy("root").agg(F.count("*").alias("heads")).join(sizes, "root").filter("heads = n").select("root")
    back = cut_lineage(links.join(cycles.withColumnRenamed("root", "b"), "b", "left_anti").select(F.col("b").alias("node"), F.col("a").alias("up")))
    at = cut_lineage(nodes.join(back, "node", "left").select("node", F.coalesce("up", "node").alias("head"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("place")))
    while True:
        up = at.select(F.col("node").alias("head"), F.col("head").alias("__head"), F.col("place").alias("__place"))
        far = cut_lineage(at.join(up, "head").select("node", F.col("__head").alias("head"), (F.col("place") + F.col("__place")).alias("place")))
        if far.agg(F.sum("place")).first() == at.agg(F.sum("place")).first():
            return far.select("node", F.col("head").alias("path"), "place")
        at = far
