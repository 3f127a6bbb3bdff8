"""A bounded sample of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordform.llm.common import written


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int) -> DataFrame:
    """(doc_id, text, label) of documents labelled 0 or 1 for which ``learn``
    holds, about ``bound`` per label at most: the ids with the smallest hashes,
    by a threshold from each label's count. Ids labelled both ways are left out;
    repeated rows count once. Null texts are empty."""
    known = (
        labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
        .where("label = other")
        .select("doc_id", "label")
    )
    share = {r["label"]: min(1.0, bound / r["n"]) for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    limit = F.when(F.col("label") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    some = written(known.where(unit < limit), "labels")  # about 2 * bound rows of 12 bytes: fit to broadcast
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
