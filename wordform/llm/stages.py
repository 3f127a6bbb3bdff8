"""Pipeline stages: each applies one operator's decisions to ``docs`` and
returns the columns of ``docs`` (the last stage returns its own rows).

What an operator says of a row depends on its text alone, so its report goes
back to the rows by the text's digest: null and repeated ids, and extra columns
of any name, make no difference. Null and empty texts are rejected by the first
stage; the others keep them. Empty tables pass through."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordform.llm import bpe, langid, ngram_join, pii
from wordform.llm.common import fold, table, unused, without, written
from wordform.llm.decontam import decontaminate

#: A text whose best language scores less is in none that was learned.
LANGUAGE_SCORE = 0.3
#: Near duplicates: words of a shingle, similarity in percent.
DUPLICATE_WORDS, DUPLICATE_PERCENT = 5, 80


#: Bytes that a task and its Python worker exchange at once. Stages follow each
#: other in the same executors, which keep the memory that one stage took; Spark's
#: default of 64 MB is held several times over, in Arrow buffers on both sides.
BATCH_KEY, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4194304b"


def small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage in whose session batches are small, unless they were set already.
    The setting stays: what a stage returns runs after it."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_KEY) == BATCH_DEFAULT:
            spark.conf.set(BATCH_KEY, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


def _text():
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


@small_batches
def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows, learned from three folds of four."""
    model = langid.fit(docs.where(fold("doc_id", 4) != 2), "text", "lang")
    judged = langid.identify(docs.select(F.md5(_text()).alias("digest"), "text"), model, ["digest"])
    return without(docs, judged.where(f"lang_pred = 'und' or score < {LANGUAGE_SCORE}"), F.md5(_text()), "digest")


@small_batches
def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: that with the smallest
    id; rows that repeat it go too."""
    rows = written(
        ngram_join.near_duplicates(docs, k=DUPLICATE_WORDS, percent=DUPLICATE_PERCENT).where("component is not null").select("doc_id", "digest", "component"),
        "members",
    )
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    first = rows.groupBy("component").agg(F.min(row).alias("first"), F.count("*").alias("m")).where("m > 1")
    key = lambda doc_id, digest: F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), digest)
    marked = written(
        rows.join(first, "component").select(
            key(F.col("doc_id"), F.lower(F.hex("digest"))).alias("key"), key(F.col("first.doc_id"), F.lower(F.hex("first.digest"))).alias("first")
        ),
        "marked",
    )
    kept = without(docs, marked.where("key <> first"), key(F.col("doc_id"), F.md5(_text())), "key")
    # a kept row that is there more than once: few, so only these are shuffled
    often = written(marked.where("key = first").groupBy("key").count().where("count > 1").select("key"), "often")
    mine = key(F.col("doc_id"), F.md5(_text()))
    own = unused(docs, "_mine")
    once = without(kept, often, mine, "key", keep=True).withColumn(own, mine).dropDuplicates([own]).drop(own)
    return without(kept, often, mine, "key").unionByName(once)


@small_batches
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark doesn't contaminate."""
    report = decontaminate(docs.select(F.md5(_text()).alias("digest"), "text"), table(spark, sf_dir, "benchmark"), doc_id="digest")
    return without(docs, report.where("contaminated"), F.md5(_text()), "doc_id")


@small_batches
def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind, ``n_chars`` to match."""
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(*others).alias("row"), "text")
    out = pii.scan(packed, pii.fit(docs), ["row"], ["redacted"])
    value = {c: F.col(f"row.`{c}`") for c in others} | {"text": F.col("redacted")}
    if "n_chars" in others:
        value["n_chars"] = F.when(F.col("redacted").isNull(), value["n_chars"]).otherwise(F.length("redacted").cast(docs.schema["n_chars"].dataType))
    return out.select(*[value[c].alias(c) for c in docs.columns])


@small_batches
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path(bpe.TOKENIZER), ["doc_id"], ["n_tokens", "ids", "ids_sha256", "decoded_sha256"])
