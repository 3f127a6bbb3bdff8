"""Word-list sources: communities, prefixes, suffixes, vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordform.functions.text import strip_ws


def read_communities(spark: SparkSession, path: str) -> DataFrame:
    """One community name per line, stripped, distinct, case kept."""
    return communities_from_lines(spark.read.text(path))


def communities_from_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    return lines.select(strip_ws(F.col(col)).alias("subreddit")).where(F.col("subreddit") != "").distinct()


def affixes_from_lines(prefix_lines: DataFrame, suffix_lines: DataFrame, col: str = "value") -> DataFrame:
    """``prefix-`` / ``-suffix`` lines → DataFrame(affix, kind).

    One marker dash is removed, then white space; empty entries are dropped
    (an empty affix would match every word).
    """
    p = prefix_lines.select(strip_ws(F.regexp_replace(F.col(col), "-$", "")).alias("affix"), F.lit("prefix").alias("kind"))
    s = suffix_lines.select(strip_ws(F.regexp_replace(F.col(col), "^-", "")).alias("affix"), F.lit("suffix").alias("kind"))
    return p.unionByName(s).where(F.col("affix") != "").distinct()


def read_affixes(spark: SparkSession, prefix_path: str, suffix_path: str) -> DataFrame:
    return affixes_from_lines(spark.read.text(prefix_path), spark.read.text(suffix_path))


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """Tokeniser vocabulary: one entry per line, kept exactly, distinct."""
    return spark.read.text(path).select(F.col("value").alias("token")).where(F.col("token") != "").distinct()
