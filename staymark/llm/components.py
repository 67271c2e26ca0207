"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymark.llm.common import Kept


def components(links: DataFrame, kept: Kept, label: str = "components") -> DataFrame:
    """Smallest node reachable from each node of ``links`` (a, b: long, not null).

    Returns node, component for every node that has a link to another. Each round first
    links all larger neighbours of a node to its smallest one, then the node and its
    smaller neighbours; paths shrink to stars in logarithmically many rounds, and the rounds end when one look
    at each node's neighbours finds nothing but stars. A hub's rows
    are pre-aggregated before each shuffle, its join may be split, and each round is a
    written table, so lost executors cost one round at most.
    """

    def both(edges: DataFrame) -> DataFrame:
        turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        return edges.unionByName(turned)

    def large(edges: DataFrame) -> DataFrame:
        around = both(edges)
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))

    def small(edges: DataFrame) -> DataFrame:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        moved = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        return moved.unionByName(least.select("a", F.col("least").alias("b")))

    def stars(edges: DataFrame) -> bool:
        """Whether every node has one smaller neighbour, or only larger ones."""
        above = edges.select(F.col("a").alias("node"), F.col("b").alias("least"))
        below = edges.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("least"))
        nodes = above.unionByName(below).groupBy("node").agg(
            F.min("least").alias("lo"), F.max("least").alias("hi"), F.bool_or(F.isnull("least")).alias("under")
        )
        return nodes.where("lo <> hi OR (lo IS NOT NULL AND under)").isEmpty()

    edges = kept.write(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        label,
    )
    while not stars(edges):
        edges = kept.write(small(large(edges)).where("a <> b").distinct(), label)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
