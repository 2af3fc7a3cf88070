"""Connected components of an edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revcat.session import written

#: Nodes (two identifiers and the smaller of their neighbours) that may be broadcast; beyond, the same joins shuffle.
BROADCAST_NODES = 50_000


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (u, v): root is the smallest node it is connected with.

    Rounds until each component is a star, logarithmic in its size. A node with very
    many links is one row per link throughout; its minimum is combined before the
    shuffle. The smallest neighbours of few nodes are broadcast, so that a round
    shuffles them alone and not the links. No edges give no rows.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    while True:
        links = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends = written(links.groupBy("u").agg(F.min("v").alias("least"), F.max("v").alias("most")), "ends")
        # A star: the neighbours of a node are all larger, or one smaller.
        summary = ends.agg(F.count("*").alias("n"), F.count_if(F.expr("least < u AND least <> most")).alias("open")).first()
        if not summary["open"]:
            return ends.select(F.col("u").alias("node"), F.least("u", "least").alias("root"))
        few = summary["n"] <= BROADCAST_NODES
        least = ends.select(F.col("u").alias("v"), F.least("u", "least").alias("m"))
        large = now.join(F.broadcast(least) if few else least, "v").select("u", F.col("m").alias("v"))
        large = large if few else large.distinct()  # else both uses of it would join again
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # The link with the smallest neighbour itself stays, the others move from the node to that neighbour.
        small = large.join(F.broadcast(least) if few else least, "u")
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = written(small if few else small.distinct(), "edges")
