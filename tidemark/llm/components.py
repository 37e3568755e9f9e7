"""Connected components of an edge table, by alternating large and small stars.

Every round is a minimum per node and a join, so a hub's edges stay rows of a table and are never
collected. Rounds grow with the logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.files import scratch_path, snapshot


def _with_minimum(directed: DataFrame) -> DataFrame:
    """(u, v, m): m is the smallest of u and its neighbours; v the neighbour.

    The join has the node's hash as second column, so that both sides are shuffled for it and
    adaptive execution may split a hub.
    """
    least = directed.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hashed = lambda df: df.withColumn("_h", F.xxhash64("u"))
    return hashed(directed).join(hashed(least), ["u", "_h"]).drop("_h")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another; root is the component's smallest node.

    Null ends and loops are ignored; repeated and reversed edges count once. No edges give no rows.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    pairs = pairs.filter("_a is not null and _b is not null and u <> v").select("u", "v").distinct()
    folder = scratch_path(edges.sparkSession, "components")
    pairs = snapshot(pairs, f"{folder}/0")
    before, round_ = None, 0
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(pairs.select("v", "v").distinct())
        before, round_ = state, round_ + 1
        both = pairs.union(pairs.select("v", "u"))
        large = _with_minimum(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = _with_minimum(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m"))
        # Written and read back each round: plans stay short, and lost executors cost no round.
        pairs = snapshot(small.filter("u <> v").distinct(), f"{folder}/{round_}")
