"""Affix productivity: V (types), N (tokens), hapax count per affix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def productivity(merged: DataFrame, modes: list[str] | None = None, with_ratio: bool = False) -> DataFrame:
    """One row per (mode, affix): v = rows, n = sum of counts, abshapax =
    rows with count 1. ``with_ratio`` adds p = abshapax / n.

    A single grouped aggregate with map-side partial aggregation; a hot
    affix costs one partial row per map task."""
    df = merged if modes is None else merged.where(F.col("mode").isin(modes))
    out = df.groupBy("mode", "affix").agg(
        F.count(F.lit(1)).alias("v"),
        F.sum("count").alias("n"),
        F.count_if(F.col("count") == 1).alias("abshapax"),
    )
    if with_ratio:
        out = out.withColumn("p", F.col("abshapax") / F.col("n"))
    return out


def observe_rows(df: DataFrame, name: str):
    """Progress counter: returns (df, Observation) where the observation
    reports ``rows`` (and ``corrupt`` rows when the column exists) once an
    action on ``df`` or a DataFrame derived from it has run. Metrics are
    aggregated by Spark alongside the job, no extra pass."""
    from pyspark.sql import Observation

    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if "corrupt" in df.columns:
        metrics.append(F.count_if(F.col("corrupt")).alias("corrupt"))
    return df.observe(obs, *metrics), obs
