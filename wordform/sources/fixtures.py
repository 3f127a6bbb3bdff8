"""Stand-in inputs derived by Spark from the supplied ``documents`` table.

No German lexicon or tokeniser vocabulary ships with the test data, so the
harness derives both from the documents that the language filter takes for
German (rules fixed below), and uses the documents themselves as comments
(id = doc_id, subreddit = source, body = text). Everything scales with
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordform.operators.filters import lang_filter
from wordform.sources.lexicon import clean_lexicon

WORD_RE = r"\p{L}+"
# Fixed values of the fixture rules.
VOCAB_MIN_COUNT = 5
LEXICON_MIN_COUNT = 3
LEXICON_MIN_CHARS = 3
FIXTURE_POS = ["NN", "VVINF", "ADJD", "ADJA", "KON"]
# Fixture community list: names as they would appear in a list file,
# including padding, a duplicate and a case variant that must not match.
FIXTURE_COMMUNITY_LINES = ["src1", " src4", "src7 ", "src7", "SRC2", "src12", "src19", "nonexistent"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as comments: doc_id, subreddit, body."""
    return documents(spark, sf_dir).select("doc_id", F.col("source").alias("subreddit"), F.col("text").alias("body"))


def german_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comments that the language filter takes for German."""
    return lang_filter(comments(spark, sf_dir), "body", "de")


def word_counts(docs: DataFrame, text: str = "body") -> DataFrame:
    """Letter runs (case kept) of the texts with their counts: w, n."""
    w = docs.select(F.explode(F.regexp_extract_all(text, F.lit(WORD_RE), 0)).alias("w"))
    return w.groupBy("w").agg(F.count(F.lit(1)).alias("n"))


def fixture_vocab(wc: DataFrame) -> DataFrame:
    return wc.groupBy(F.lower("w").alias("token")).agg(F.sum("n").alias("n")).where(
        F.col("n") >= VOCAB_MIN_COUNT
    ).select("token")


def fixture_lexicon_raw(wc: DataFrame, least_count: int = LEXICON_MIN_COUNT, least_chars: int = LEXICON_MIN_CHARS) -> DataFrame:
    """Raw lexicon rows incl. rows cleaning must drop. File order is
    n descending, w ascending; ``line_ord`` grows along that order."""
    wc = wc.where((F.col("n") >= least_count) & (F.length("w") >= least_chars))
    lw = F.lower("w")
    base = (
        F.when(F.col("n") % 11 == 0, F.lit("unknown"))
        .when(lw.endswith("en"), lw)
        .when(F.length("w") % 3 == 0, F.concat(lw, F.lit("en")))
        .otherwise(F.col("w"))
    )
    pos = F.when(F.col("n") % 13 == 0, F.lit("$(")).otherwise(
        F.element_at(F.array(*[F.lit(p) for p in FIXTURE_POS]), (F.length("w") % 5 + 1).cast("int"))
    )
    return wc.select(
        F.col("w").alias("word"),
        base.alias("base"),
        pos.alias("pos"),
        F.col("n").cast("double").alias("frequency"),
        F.struct((-F.col("n")).alias("neg_n"), F.col("w").alias("w")).alias("line_ord"),
    )


def fixture_lexicon(wc: DataFrame, least_count: int = LEXICON_MIN_COUNT, least_chars: int = LEXICON_MIN_CHARS) -> DataFrame:
    return clean_lexicon(fixture_lexicon_raw(wc, least_count, least_chars), order_col="line_ord")


def fixture_communities(spark: SparkSession) -> DataFrame:
    from wordform.sources.lists import communities_from_lines

    lines = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in FIXTURE_COMMUNITY_LINES])).alias("value"))
    return communities_from_lines(lines)


# ------------------------------------------------------- files of the sources

#: Every so many documents add a malformed line to the stand-in dumps.
MALFORMED_EVERY = 10
DUMP_YEAR = 2019


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def write_lines(lines: DataFrame, path: str) -> str:
    """A folder of text files from a one-column table."""
    lines.write.text(path)
    return path


def write_dumps(spark: SparkSession, c: DataFrame, path: str, months=range(1, 13)) -> str:
    """Comments as monthly dumps ``RC_2019-MM_k`` in one folder (month =
    doc_id % 12 + 1), with malformed lines and one stray file beside them; those of
    other ``months`` wait for ``add_dumps``."""
    month = (F.col("doc_id") % 12 + 1).cast("int").alias("month")
    good = c.select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "subreddit", "body")).alias("value"), month)
    bad = c.where(F.col("doc_id") % MALFORMED_EVERY == 0).select(F.concat(F.lit("not json "), "doc_id").alias("value"), month)
    good.unionByName(bad).write.partitionBy("month").text(f"{path}-parts")
    write_lines(spark.createDataFrame([("0 RC_2019-01",)], "value string").coalesce(1), f"{path}-stray")
    fs, Path = _fs(spark, path)
    fs.mkdirs(Path(path))
    add_dumps(spark, path, months)
    for status in fs.globStatus(Path(f"{path}-stray/part-*")):
        fs.rename(status.getPath(), Path(f"{path}/checksums.txt"))
    return path


def add_dumps(spark: SparkSession, path: str, months) -> None:
    """Let the given months' dumps arrive in the folder."""
    fs, Path = _fs(spark, path)
    for m in months:
        for i, status in enumerate(fs.globStatus(Path(f"{path}-parts/month={m}/part-*")) or []):
            fs.rename(status.getPath(), Path(f"{path}/RC_{DUMP_YEAR}-{m:02d}_{i}"))


def write_lexicon(raw: DataFrame, path: str) -> str:
    """Raw lexicon rows as one TSV file in line order (a lexicon is one file)."""
    rows = raw.orderBy("line_ord").select("word", "base", "pos", "frequency")
    rows.coalesce(1).write.option("sep", "\t").csv(path)
    return path
