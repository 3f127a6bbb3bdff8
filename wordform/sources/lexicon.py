"""Lexicon source (headerless TSV: word, base, pos, frequency) and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEXICON_SCHEMA = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("base", T.StringType()),
        T.StructField("pos", T.StringType()),
        T.StructField("frequency", T.DoubleType()),
    ]
)


def read_lexicon_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw lexicon rows with ``line_no`` increasing in file order.

    ``monotonically_increasing_id`` grows with the split index and the row
    inside a split; the splits of one file keep their offset order, so for a
    single lexicon file (the published format) it orders lines as read. For
    several files pass a table with an explicit order column to
    ``clean_lexicon`` instead.
    """
    df = (
        spark.read.option("sep", "\t")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
        .schema(LEXICON_SCHEMA)
        .csv(path)
    )
    return df.withColumn("line_no", F.monotonically_increasing_id())


def clean_lexicon(raw: DataFrame, order_col: str = "line_no") -> DataFrame:
    """Drop rows without frequency, with base ``unknown``/``UNKNOWN`` or a POS
    holding ``$``; lower-case the word; the last row per word wins.

    The dedupe is a ``max_by`` aggregate (partial aggregation, no window).
    """
    kept = (
        raw.where(F.col("frequency").isNotNull())
        .where(F.col("base").isNull() | ~F.col("base").isin("unknown", "UNKNOWN"))
        .where(F.col("pos").isNull() | ~F.col("pos").contains("$"))
        .withColumn("word", F.lower("word"))
        .where(F.col("word").isNotNull())
    )
    return kept.groupBy("word").agg(
        F.max_by(F.struct("base", "pos", "frequency"), F.col(order_col)).alias("e")
    ).select("word", "e.base", "e.pos", "e.frequency")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    return clean_lexicon(read_lexicon_raw(spark, path))
