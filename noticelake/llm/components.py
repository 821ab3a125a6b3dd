"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.llm.common import dealt_checkpoint


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has columns a, b (longs). Returns node, component (smallest node reachable) for every node with an edge.

    Every round is two aggregations and two joins on node keys; a hub costs one row per map task in the
    aggregations, and its neighbours are split by the adaptive skew join. Nothing but the count and checksum
    of the edges reaches the driver. Nulls and self-loops are ignored.
    """
    current = dealt_checkpoint(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = _signature(current)
    while seen[0]:
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = dealt_checkpoint(small.union(lowest).distinct())
        now = _signature(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
