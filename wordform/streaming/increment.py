"""Month-at-a-time operation.

The reference processes one monthly dump at a time and merges the monthly
tables afterwards. ``operators.corpus.merge_increment`` folds a new
month's table into the merged one; here:

* ``stream_counts`` keeps the counts of all months merged while they arrive: a
  streaming aggregate of tokens whose state store, under the query's checkpoint,
  is the merged table. A state version belongs to a batch id and the source's log
  says which files a batch holds, so a batch that is run again after a failure,
  or a query that is stopped and started, counts no file twice. ``merged_counts``
  reads the state as a table and ``merged_derivatives`` analyses its tokens: an
  analysis depends on the token only, so this is the merge of all months' tables,
  without reading an old month again.
* ``stream_filter_comments`` runs the comment filter as a Structured
  Streaming query over a folder where monthly dumps arrive; it is stateless
  (semi-join with a static list, row filters), so it runs in append mode and
  its checkpoint makes it restart where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordform.operators.analyze import Resources, analyze, gated
from wordform.operators.corpus import merge_months
from wordform.operators.segment import sentences, tokens
from wordform.plans.stages import filter_comments
from wordform.session import cut_lineage
from wordform.sources.comments import DUMP_GLOB, parse_comments


def _dump_lines(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.format("text").option("pathGlobFilter", DUMP_GLOB)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(input_dir).withColumn("file", F.input_file_name())


def stream_counts(
    spark: SparkSession,
    input_dir: str,
    resources: Resources,
    checkpoint_dir: str,
    communities: DataFrame | None = None,
    lang: str | None = "de",
    filtered: bool = False,
    trigger_once: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Start (or go on with) the running token counts of the dumps in
    ``input_dir``; returns the StreamingQuery. ``filtered``: the dumps hold
    comments that need no filter.

    A vocabulary within the broadcast bounds is probed before tokens reach the
    state; a larger one only when the state is read, on distinct tokens. Partial
    aggregation runs before the state's shuffle, so a hot token is one row per task
    and batch."""
    comments = parse_comments(_dump_lines(spark, input_dir, max_files_per_trigger)).where(~F.col("corrupt"))
    kept = comments if filtered else filter_comments(comments, communities, lang=lang)
    toks = tokens(sentences(kept, ["id"], "body"), ["id"])
    if resources.vocab_known is None:
        toks = gated(toks, resources)
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    # the state is the table: nothing else needs to be written
    writer = counts.writeStream.format("noop").option("checkpointLocation", checkpoint_dir).outputMode("update")
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def merged_counts(spark: SparkSession, checkpoint_dir: str) -> DataFrame:
    """(token, count) of all batches that ``stream_counts`` has committed; one task
    per state partition."""
    state = spark.read.format("statestore").load(checkpoint_dir)
    return state.select(F.col("key.token").alias("token"), F.col("value.count").alias("count"))


def merged_derivatives(spark: SparkSession, checkpoint_dir: str, resources: Resources) -> DataFrame:
    """The merged derivative table as of the last committed batch."""
    counts = merged_counts(spark, checkpoint_dir)
    if resources.vocab_known is not None:
        counts = gated(cut_lineage(counts, "all-counts"), resources)
    return merge_months([analyze(counts, resources=resources, gate=False)])


def stream_filter_comments(
    spark: SparkSession,
    input_dir: str,
    communities: DataFrame,
    output_dir: str,
    checkpoint_dir: str,
    lang: str = "de",
    trigger_once: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Start the streaming comment filter; returns the StreamingQuery."""
    lines = _dump_lines(spark, input_dir, max_files_per_trigger)
    kept = filter_comments(parse_comments(lines), communities, lang=lang)
    writer = (
        kept.select("id", "subreddit", "body", "raw", "year", "month")
        .writeStream.format("parquet")
        .option("path", output_dir)
        .option("checkpointLocation", checkpoint_dir)
        .partitionBy("year", "month")
        .outputMode("append")
    )
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
