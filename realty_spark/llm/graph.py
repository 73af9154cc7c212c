"""Connected components by alternating large and small stars, as joins and map-side combined minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from realty_spark.llm.common import discard, land


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (small star: smaller and own) neighbours of each node to its least neighbour."""
    both = edges.select("u", "v")
    if large:
        both = both.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # edges run from the larger to the smaller end
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        out = both.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    out = out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return out if large else out.distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and no smaller end is a larger end: then the smaller ends are the components."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    bad = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or (up > 0 and down > 0)")
    return not bad.agg(F.count("*")).first()[0]


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) for every node of the (a, b) pairs; component: the least node that it reaches."""
    edges = land(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while not _is_star_forest(edges):
        before, edges = edges, land(_star(_star(edges, True), False), "edges")
        discard(before)
    found = land(edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
                 .union(edges.select("v", "v").distinct()), "components")
    discard(edges)
    return found
