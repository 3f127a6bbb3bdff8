"""Corpus pipeline: the stages that turn ``documents`` into token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordform.llm.common import table
from wordform.llm.stages import decontaminated, deduplicated, encoded, identified, redacted
from wordform.session import cut_scope

STAGES = [
    ("language ID", identified),
    ("n-gram Jaccard join", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("PII", redacted),
    ("BPE encoding and decoding", encoded),
]

#: Trained models and iterated joins take part, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with cut_scope(spark) as keep:  # what a stage wrote for itself goes with it
            docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
