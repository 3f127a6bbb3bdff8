"""Comment dump source: monthly NDJSON files, plain or zstd-compressed.

``read_comments`` reads every ``RC_YYYY-MM`` file under a path in one job
(the month and year come from the file name, so later stages can prune and
partition by them). Hadoop's zstd codec reads ordinary ``.zst`` dumps
natively; dumps written with a long window (up to 2 GiB) need
``long_window=True``, which reads them through the data source of
``sources.dumps``: a task per range of zstd frames. A file of one frame cannot
be split, so whoever filters the lines spreads what is left
(``filter_comments(spread=...)``); raw lines are never shuffled. Only files named
``RC_*`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordform.sources.dumps import SCHEMA, scan_dumps

COMMENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)
FILE_RE = r"RC_(\d{4})-(\d{2})"


def parse_comments(lines: DataFrame, value_col: str = "value", file_col: str = "file", failfast: bool = False) -> DataFrame:
    """NDJSON lines → id, subreddit, body, raw, year, month, corrupt.

    PERMISSIVE by default: a malformed line gives ``corrupt = true`` and null
    fields; ``failfast`` raises on the first malformed line instead.
    """
    opts = {"mode": "FAILFAST"} if failfast else {"mode": "PERMISSIVE"}
    raw = F.col(value_col)
    parsed = F.from_json(raw, COMMENT_SCHEMA, opts)
    f = F.col(file_col)
    return lines.select(
        parsed.alias("j"),
        raw.alias("raw"),
        F.regexp_extract(f, FILE_RE, 1).try_cast("int").alias("year"),
        F.regexp_extract(f, FILE_RE, 2).try_cast("int").alias("month"),
    ).select(
        "j.id", "j.subreddit", "j.body", "raw", "year", "month",
        (F.col("j").isNull() | F.col("j.body").isNull()).alias("corrupt"),
    )


def line_status(raw: Column) -> Column:
    """What a dump line is: ``comment``, ``null_body``, ``no_body``, ``no_object`` (JSON,
    but not an object) or ``not_json``. The line is parsed without a schema
    (VARIANT), so a missing and a null body are told apart and unknown fields do no
    harm; ``corrupt`` of ``parse_comments`` holds for all but the first."""
    line = F.try_parse_json(raw)
    body = F.try_variant_get(line, "$.body", "variant")
    return (
        F.when(line.isNull(), "not_json")
        .when(~F.startswith(F.schema_of_variant(line), F.lit("OBJECT")), "no_object")
        .when(body.isNull(), "no_body")
        .when(F.is_variant_null(body), "null_body")
        .otherwise("comment")
    )


def month_paths(spark: SparkSession, root: str, months: list[tuple[int, int]]) -> list[str]:
    """Existing dump files ``RC_YYYY-MM[.zst]`` under ``root`` for the given
    (year, month) pairs; a missing month is skipped with a warning."""
    import logging

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for year, month in months:
        pattern = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/RC_{year:04d}-{month:02d}*")
        hits = pattern.getFileSystem(conf).globStatus(pattern) or []
        if not hits:
            logging.getLogger("wordform").warning("no dump for %04d-%02d under %s, skipped", year, month, root)
        found.extend(h.getPath().toString() for h in hits)
    return found


DUMP_GLOB = "RC_*"


def _dump_files(spark: SparkSession, path) -> DataFrame:
    """(path, length) of every compressed dump."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format("binaryFile").option("pathGlobFilter", f"{DUMP_GLOB}.zst").load(paths).select("path", "length")


def spread_partitions(spark: SparkSession, path, target_bytes: int = 64 << 20) -> int:
    """Partitions that give the listed compressed dumps about ``target_bytes`` each."""
    total = _dump_files(spark, path).agg(F.sum("length")).first()[0] or 0
    return max(1, -(-total // target_bytes))


def read_comment_lines(spark: SparkSession, path) -> DataFrame:
    """Lines of every dump under ``path`` (a folder, glob or list of files)
    with their file name."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("pathGlobFilter", DUMP_GLOB).text(paths).withColumn("file", F.input_file_name())


def read_comments(
    spark: SparkSession,
    path: str,
    long_window: bool = False,
    failfast: bool = False,
    months: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """Comments of every dump under ``path``, or only of ``months``
    ((year, month) pairs; missing months are skipped with a warning)."""
    found = None if months is None else month_paths(spark, path, months)
    if long_window:
        return scan_dumps(spark, path, months=months, failfast=failfast)
    if found is not None and not found:
        return spark.createDataFrame([], SCHEMA)
    return parse_comments(read_comment_lines(spark, found or path), failfast=failfast)


def read_filtered_comments(spark: SparkSession, path: str) -> DataFrame:
    """The filter stage's output (raw lines under year=/month= folders):
    id, body, year, month."""
    lines = spark.read.text(path)
    j = F.from_json(F.col("value"), COMMENT_SCHEMA)
    return lines.select(j.alias("j"), "year", "month").select("j.id", "j.body", "year", "month")
