"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    low = stored(low, "components-low")
    return both.where("v > u").join(low, "u") \
        .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = stored(down.groupBy("u").agg(F.min("v").alias("m")), "components-low")
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    """Changes whenever the link table changes; one row to the driver."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node that occurs in a link; ``component``
    is its smallest member. Large-star and small-star steps alternate until
    the links stop changing: then each is a star around its component."""
    edges = stored(links.select(F.col(a).alias("u"), F.col(b).alias("v"))
                   .where("u <> v").distinct(), "components")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(stored(_large_star(edges), "components")), "components")
        state, before = _state(edges), state
        if state == before:
            break
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(tops)
