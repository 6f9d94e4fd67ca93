"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge to another.

    The minima are written before the join: with two plain inputs, a node with
    a third of all edges is a skewed join, which Spark splits at run time.

    Alternating large-star and small-star steps (Kiveris et al., SoCC 2014):
    each is a minimum by node and a join on it, both of which Spark combines
    or splits when a node has very many edges. The edges are written to the
    shared folder after every round; the driver sees two numbers of them.
    """
    now = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now, before = stored(now, "edges"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        # Large star: larger neighbours of u move to u's smallest neighbour (or u).
        both = now.union(now.select("v", "u"))
        least = stored(both.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m")).select("of", F.least("of", "m").alias("m")), "least")
        large = stored(both.where("v > u").join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        # Small star: u and its smaller neighbours move to the smallest of these.
        least = stored(large.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m")), "least")
        small = large.join(least, F.col("u") == F.col("of")).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.union(least.select("of", "m")).distinct(), "edges")
    # Every edge now leads from a node to its component's smallest node.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
