"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): root is the smallest node of the component; only nodes
    that have a link are listed.

    Every round points each node's larger neighbours, then its smaller ones, at
    the smallest node seen (large star, small star). Neighbour minima are plain
    partial aggregates joined back, so a node with very many links is never
    gathered in one task. Each round is written to the shared folder; the loop
    ends only when nothing changes.
    """
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
               .filter("u != v").distinct(), "cc-edges")
    state = None
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        e = stored(small, "cc-edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = tuple(now)
