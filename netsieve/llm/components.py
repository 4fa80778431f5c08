"""Connected components of a graph whose links are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsieve.llm.store import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that has a link to another node.

    ``component`` is the smallest node within reach. Large-star and small-star steps take
    turns (Kiveris et al., "Connected Components in MapReduce and Beyond"): each keeps the
    components and pulls nodes towards their smallest neighbour, until every link leads
    there. A node with very many links is folded before the shuffle by the minimum; the join
    back is one that Spark splits when it is skewed.
    """
    links = stored(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    before = None
    while before != (state := _state(links)):
        before = state
        links = stored(_small_star(_large_star(links)), "links")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(links.select(F.col("v"), F.col("v")).distinct())


def _state(links):
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(links):
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links):
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    pulled = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return pulled.union(least.select("u", "m")).distinct()
