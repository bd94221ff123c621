"""Connected components of links between integer nodes, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countertide.llm.common import BROADCAST_ROWS
from countertide.plans.shared import freeze


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable. ``links``: columns a, b. Each round is written, so lineage stays short.

    Large-star joins larger neighbours of a node to its least neighbour, small-star the smaller ones; both keep
    components and end in stars. A hub's neighbours are never collected: the least one is found by aggregation and
    joined back. Edges that are few enough for a broadcast stay in one partition, so that rounds shuffle nothing; a round
    never makes more edges than there were.
    """
    edges = freeze(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    few = edges.count() <= BROADCAST_ROWS

    def together(rows: DataFrame) -> DataFrame:
        return rows.coalesce(1) if few else rows

    while not _is_stars(edges, together):
        both = together(edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = freeze(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct(), "large")
        large = together(large)
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = freeze(large.join(small, "u").select(F.explode(ends).alias("e")).select("e.*").filter("u != v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _is_stars(edges: DataFrame, together: Callable[[DataFrame], DataFrame]) -> bool:
    """Whether each node has one smaller neighbour at most, which has none itself."""
    ends = together(edges.select("u", F.lit(1).alias("below")).unionAll(edges.select("v", F.lit(None).cast("int"))))
    seen = ends.groupBy("u").agg(F.count("below").alias("below"), F.count(F.lit(1)).alias("all"))
    return not seen.filter("below > 1 OR (below = 1 AND all > 1)").head(1)
