"""Connected components of links between ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netforensics.session import reliable_checkpoint

from .common import release

EDGES_A_TASK = 1 << 20


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> (id, component): the smallest id that can be reached; ids without links are missing.

    Each step points the neighbours of an id to the smallest one around it, by an aggregate and a
    join; chains shorten by half, so the number of steps grows with the logarithm of their length.
    """
    spark = links.sparkSession
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = reliable_checkpoint(edges)
    before = None
    # Few edges come in few parts: rounds over them would else write a file for each pair of tasks.
    parts = max(1, -(-edges.count() // EDGES_A_TASK))
    while True:
        release(spark)
        edges = edges.coalesce(parts)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).withColumnRenamed("a", "c")
        # Large star: every larger neighbour of an id is pointed to the smallest one around it.
        large = both.join(least, both.a == least.c).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct().coalesce(parts)
        # Small star: the smaller neighbours of an id, and it itself, are pointed to the smallest of them.
        down = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "c")
        joined = large.join(down, large.a == down.c)
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select(F.col("c").alias("a"), F.col("m").alias("b")))
        edges = reliable_checkpoint(small.where("a <> b").distinct().coalesce(parts))
        state = edges.agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id").unionByName(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        before = state
