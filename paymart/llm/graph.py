"""Connected components of a graph of any size, by rounds of large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import written


def settled(stars: DataFrame) -> bool:
    """Whether each u of `stars` (u, v) has one v, and no v is a u: then the components are known."""
    ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("top"))
    ends = ends.unionByName(stars.select(F.col("v").alias("node"), F.lit(0).alias("ups"), F.lit(1).alias("top")))
    nodes = ends.groupBy("node").agg(F.sum("ups").alias("ups"), F.max("top").alias("top"))
    return nodes.agg(F.count_if(F.col("ups") + F.col("top") > 1)).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of `edges` (u, v) is linked to, itself included.

    Every round points nodes at the smallest neighbour known. Per-node minima are aggregated before the join, so a node
    with very many neighbours costs no task more than its share, and each round is cut off in the shared folder."""
    stars = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), few=True)
    while not settled(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        stars = written(small.select("e.u", "e.v").where("u <> v").distinct(), few=True)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """`classes` (node, component), one row a node, joined by `links` (u, v). Only the graph of classes that a link joins goes
    through the rounds; the members of a class follow it in one join."""
    of = classes.select(F.col("node").alias("at"), "component")
    named = links.join(of, F.col("u") == F.col("at"), "left").select(F.coalesce("component", "u").alias("u"), "v")
    named = named.join(of, F.col("v") == F.col("at"), "left").select("u", F.coalesce("component", "v").alias("v"))
    moved = components(named).select(F.col("node").alias("at"), F.col("component").alias("to"))
    kept = classes.join(moved, F.col("component") == F.col("at"), "left").select("node", F.coalesce("to", "component").alias("component"))
    new = moved.select(F.col("at").alias("node"), F.col("to").alias("component")).join(classes.select("node"), "node", "left_anti")
    return written(kept.unionByName(new), few=True)
