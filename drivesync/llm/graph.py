"""Connected components by contraction, in a few rounds of joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivesync.llm.common import stored


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node, root`` of all nodes of ``edges`` (``a``, ``b``: long). ``root``
    is one node of the component.

    Every round joins each node to its least neighbour, in an order by hash, so
    that no chain of ids is slow, and goes on with what the edges become.
    """
    edges = stored(edges.select(F.xxhash64("a").alias("x"), "a", F.xxhash64("b").alias("y"), "b")
                   .select(F.struct("x", "a").alias("a"), F.struct("y", "b").alias("b"))
                   .select(F.struct(F.col("a.x").alias("h"), F.col("a.a").alias("id")).alias("a"),
                           F.struct(F.col("b.y").alias("h"), F.col("b.b").alias("id")).alias("b"))
                   .where("a.id <> b.id"), label)
    roots = edges.select("a", "b").limit(0).select(F.col("a").alias("node"), F.col("b").alias("root"))
    first = True
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
            "node", F.least("node", "m").alias("up")), label)
        if first:
            roots, first = parent.withColumnRenamed("up", "root"), False
        else:
            roots = stored(roots.join(parent, roots["root"] == parent["node"], "left").select(
                roots["node"], F.coalesce("up", "root").alias("root")), label)
        ends = edges.join(parent.select(F.col("node").alias("a"), F.col("up").alias("p")), "a").join(
            parent.select(F.col("node").alias("b"), F.col("up").alias("q")), "b")
        edges = stored(ends.where("p.id <> q.id").select(F.col("p").alias("a"), F.col("q").alias("b")).distinct(), label)
    return roots.select(F.col("node.id").alias("node"), F.col("root.id").alias("root"))
