"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordform.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of ``edges`` with the smallest node it
    reaches. Each round hangs larger neighbours of a node on its smallest one,
    then smaller ones; the rounds grow with the logarithm of the longest path.
    Only minima per node are grouped, so a node of any degree is combined before
    the shuffle. Self-loops and nulls are left out."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = written(e, "edges")

    def fingerprint(df: DataFrame):
        return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()

    state = fingerprint(e)
    while True:
        # large star: the larger neighbours of u hang on its smallest neighbour
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        e = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        e = written(e, "large-star")
        # small star: the smaller neighbours of u, and u, hang on the smallest of them
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        hung = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(hung.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "small-star")
        now = fingerprint(e)
        if now == state:
            break
        state = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
