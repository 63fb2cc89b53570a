"""Connected components by distributed union-find: alternating large-star and small-star steps.

Each step hangs vertices under the least vertex they know of (Kiveris et al., 2014); it ends when every component is
a star around its least vertex, after about log(vertices) rounds. A round's edges are a written table, so no lineage
grows and no vertex's neighbours are ever gathered in one row. Minima are combined before the shuffle; the join that
hands a hub's minimum to its neighbours reads written tables on both sides, so that Spark can split a hot hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.tables import dropped, written


def components(links: DataFrame) -> DataFrame:
    """``links``: u, v (any ordered type, not null). Returns node, root for every vertex but the roots themselves:
    root is the least vertex of the node's component."""
    edges = written(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                    "edges")
    while not _stars(edges):
        least = written(edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
                        .unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
                        .groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")), "least")
        # large star: the greater neighbours y of x go under the least of x's neighbours and x
        large = written(edges.select(F.col("v").alias("x"), F.col("u").alias("y")).join(least, "x")
                        .select(F.col("y").alias("u"), F.col("m").alias("v")).distinct(), "large")
        below = written(large.groupBy("u").agg(F.min("v").alias("m")), "below")
        # small star: u and its lesser neighbours go under the least of these
        turned = (large.join(below, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(below.select("u", F.col("m").alias("v"))).distinct())
        after = written(turned, "edges")
        for done in (edges, least, large, below):
            dropped(done)
        edges = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """No vertex has two parents, and no parent has a parent."""
    twice = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
    upper = edges.select(F.col("v").alias("u")).distinct().join(edges.select("u"), "u", "left_semi")
    return twice.isEmpty() and upper.isEmpty()
