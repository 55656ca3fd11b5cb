"""Connected components of a graph of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.llm.common import scratch_table


def _ends(edges: DataFrame) -> DataFrame:
    """``(node, other)``: each edge from both of its ends."""
    ways = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("other")),
                   F.struct(F.col("v").alias("node"), F.col("u").alias("other")))
    return edges.select(F.explode(ways).alias("way")).select("way.*")


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node of ``edges(u > v)`` has two smaller neighbours, or one
    smaller and one larger: then each ``v`` is the smallest of its component."""
    by = _ends(edges).groupBy("node").agg(F.sum((F.col("other") < F.col("node")).cast("int")).alias("smaller"),
                                          F.max(F.col("other") > F.col("node")).alias("larger"))
    return not by.where("smaller > 1 or smaller = 1 and larger").agg(F.count("*")).first()[0]


def connected(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(u, v)``, the component
    being its smallest node.  Nulls are no nodes; a link to itself makes a
    component of one.

    A large-star step hangs the larger neighbours of each node on the smallest
    node around it, a small-star step does so with the smaller ones; the edges
    shrink to stars in about log(nodes) rounds, and the first stars end it.
    Every step is a partial minimum and a join on the node, which Spark can
    split where one node has very many links; each round is written out before
    the next."""
    links = links.where("u is not null and v is not null")
    own = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    edges = scratch_table(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                          .distinct(), "edges")
    while not _are_stars(edges):
        least = _ends(edges).groupBy(F.col("node").alias("u")).agg(F.least(F.min("other"), F.first("node")).alias("m"))
        large = (edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = scratch_table(small, "edges")
    top = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("_top"))
    return own.join(top, "node", "left").select("node", F.coalesce("_top", "node").alias("component"))
