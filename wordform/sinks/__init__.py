"""Writers for every stage output (Parquet / text / CSV instead of Excel).

All writers are partitioned by the columns a later stage prunes on. Monthly
tables overwrite only the months they write (dynamic partition overwrite), so
a re-run of one month does not touch the others. Tables made from the whole
joined table (joined, corpora, productivity) are replaced as a whole: nothing
of an earlier result stays beside the new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _months(df: DataFrame):
    """Overwrite only the partitions present in ``df`` (per-write option; the
    session setting is left alone)."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def _whole(df: DataFrame):
    """Overwrite everything there is, whatever the session setting."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static")


def write_filtered_comments(df: DataFrame, path: str, partition_cols=("year", "month")) -> None:
    """The raw, unsanitised line of every kept comment, as text, per month."""
    cols = [c for c in partition_cols if c in df.columns]
    _months(df.select("raw", *cols)).partitionBy(*cols).text(path)


def write_derivatives(df: DataFrame, path: str, partition_cols=("year", "month")) -> None:
    """Monthly derivative tables (summary or long form)."""
    cols = [c for c in partition_cols if c in df.columns]
    _months(df).partitionBy(*cols).parquet(path)


def write_joined(df: DataFrame, path: str) -> None:
    _whole(df).parquet(path)


def write_corpora(df: DataFrame, path: str) -> None:
    """SHARED and SPLIT corpora, one directory per condition/mode/bin/split."""
    _whole(df).partitionBy("condition", "mode", "bin", "split").parquet(path)


def write_productivity(df: DataFrame, path: str) -> None:
    """CSV with one header per mode directory: affix,v,n,abshapax."""
    _whole(df.select("mode", "affix", "v", "n", "abshapax")).partitionBy("mode").option("header", True).csv(path)
