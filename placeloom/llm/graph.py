"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeloom.llm.common import stage, unstage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links a node's neighbours (large: those above it; else: those below it, and itself) to the least of all."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    linked = both.join(least, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component: the least node that each node of an edge reaches; nodes without an edge are absent.

    Large and small stars by turns, until nothing changes: a number of rounds that grows with the logarithm of the
    longest path. Each round is a table in the shared folder, and goes once the next one is written. A node with very many edges is grouped by partial sums
    and joined where skewed partitions are split. Loops, repeated edges and null ends go; no edges give no rows.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    before, last = None, None
    while True:
        now = stage(_star(_star(now, True), False), "star")
        if last is not None:
            unstage(last)
        last = now
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
