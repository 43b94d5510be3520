"""Connected components of an edge table by alternating star contractions, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarspark.session import reliable_checkpoint


def _large_star(edges: DataFrame) -> DataFrame:
    """Every vertex links its larger neighbours to its least neighbour or itself."""
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex links itself and its smaller neighbours to the least of them. Edges come as u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
    joined = edges.join(least, F.col("u") == F.col("c"))
    return (joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .union(least.select(F.col("c").alias("u"), F.col("m").alias("v")))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node of its component; only nodes that have an edge to another one.

    Both contractions keep components and shorten paths; they end when every node hangs on its root. Each round is
    written to the shared checkpoint folder, so a lost executor costs one round. The driver sees one checksum a round.
    """
    now = edges.toDF("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, before = reliable_checkpoint(now, "edges"), None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state["n"] == 0 or (state["n"], state["s"]) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = (state["n"], state["s"])
        now = reliable_checkpoint(_small_star(_large_star(now).distinct()), "edges")
