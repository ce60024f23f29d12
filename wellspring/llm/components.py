"""Connected components by alternating large-star and small-star steps.

Every step is a few joins and aggregations on Spark; nothing is gathered on the driver but a
count and a checksum of the edges. Each round is staged, so lineage stays short and a lost
executor costs one round at most.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.workspace import stage_measured


def _measures() -> dict:
    pair = F.xxhash64("u", "v")
    return {"n": F.count(F.lit(1)), "mark": F.sum(pair.cast("decimal(38,0)"))}


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest of them (u > v in and out).

    Large star: of all neighbours, the larger ones. Small star: of the smaller neighbours,
    those and the node itself."""
    around = edges
    if both_ways:
        around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    if both_ways:
        least = least.select("u", F.least("u", "m").alias("m"))
        moved = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = around.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u > v").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node in ``edges`` (u, v longs); root is the smallest node reached."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges, before = stage_measured(edges.where("u > v").distinct(), f"{name}-edges", **_measures())
    while before["n"]:
        edges, after = stage_measured(_star(_star(edges, True), False), f"{name}-stars", **_measures())
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
