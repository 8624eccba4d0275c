"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import drop, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that links lead to, for every node with a link.

    Each round links all larger neighbours of a node to its smallest one (large star), then all smaller
    ones (small star); the minimum is a partial aggregate, so a hub's links are combined before they are
    shuffled. Rounds grow with the logarithm of the longest path. Each round's links are a written table.
    Self links and nulls are ignored; an empty table gives an empty one.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges = written(edges, name)
    before = _state(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(least, "u")
        small = star.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        last, edges = edges, written(small.filter("u > v").distinct(), name)
        drop(last)
        after = _state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()).groupBy("node").agg(F.min("component").alias("component"))
