"""Connected components of a stored edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.session import keep


def _shape(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node that each node of an edge reaches; other nodes are their own roots.

    Each round hangs every larger neighbour, then every smaller one, under the
    smallest of the neighbourhood, until nothing moves; the rounds grow with the
    logarithm of the longest chain. Every round is a written table.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    current = keep(edges.filter(F.col(a) != F.col(b)).select(high, low).distinct(), "edges")
    shape = _shape(current)
    while shape[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select("u", "v", "m")
        small = hung.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = keep(small.unionByName(hung.select("u", F.col("m").alias("v"))).distinct(), "edges")
        next_shape = _shape(following)
        if next_shape == shape:
            break
        current, shape = following, next_shape
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
