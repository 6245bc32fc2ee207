"""Connected components of links between numbered nodes."""

from pyspark.sql import functions as F

from ..session import cut_lineage


def _state(edges):
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges, rounds=60):
    """Smallest node reachable from each node that has a link.

    ``edges``: a, b. Returns node, component. Nodes and ends that are null, and
    links of a node to itself, are left out. Alternates large and small stars:
    every round is two grouped minima and joins on the node, so neither a
    hub's neighbours nor the list of links is ever gathered in one place.
    """
    edges = cut_lineage(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(edges)
    while before[0] and rounds:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        edges = cut_lineage(small.where("a <> b").distinct())
        after = _state(edges)
        if after == before:
            break
        before, rounds = after, rounds - 1
    else:
        if before[0]:
            raise RuntimeError("links did not settle; raise rounds")
    return edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
