"""Connected components by alternating large and small stars, each round written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, folder: str) -> DataFrame:
    """``node, root`` of every node of ``links`` (``u, v``); the root is the least node reachable.

    A round joins edges to one minimum per node, so a node with very many links only makes a
    skewed join, which adaptive execution splits. Rounds are written below ``folder``.
    """
    spark = links.sparkSession
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    last = None
    number = 0
    while True:
        path = f"{folder}/round-{number}"
        (edges if number == 0 else _star_round(edges)).distinct().write.parquet(path)
        edges = spark.read.schema("u long, v long").parquet(path)
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == last or state[0] == 0:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(edges.select("v", "v").distinct())
        last, number = state, number + 1


def _star_round(edges: DataFrame) -> DataFrame:
    """Link larger neighbours to the least one, then smaller neighbours; edges keep ``u > v``."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # A node is its own least neighbour at a root; such edges say nothing.
    large = large.where("u > v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(least)
