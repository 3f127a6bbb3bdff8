"""Every harness query against its DuckDB oracle on the smallest data set,
and the expected derivative counts of the fixture notes at sf0.001."""

import hashlib
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from wordform import PREFIX_FILE, SUFFIX_FILE
from wordform.plans.harness import QUERIES
from wordform.plans.oracle import oracle_queries
from wordform.plans.stages import find_derivatives
from wordform.sources import fixtures as fx
from wordform.sources.lists import read_affixes


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(hashlib.md5("\x1f".join(_norm(r[i]) for i in order).encode()).hexdigest() for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
    names = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "StringType()": "VARCHAR",
             "BooleanType()": "BOOLEAN", "DoubleType()": "DOUBLE"}
    otypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    for f in df.schema.fields:
        assert names.get(repr(f.dataType)) == otypes[f.name], (name, f.name)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry(spark):
    assert E.entry(spark).count() > 0


def test_expected_counts(spark):
    """Derivatives of the documents that are labelled German."""
    docs = fx.documents(spark, SF_SMALL).where("lang = 'de'").select("doc_id", F.col("text").alias("body"))
    words = fx.word_counts(docs)
    df = find_derivatives(docs, read_affixes(spark, PREFIX_FILE, SUFFIX_FILE), fx.fixture_lexicon(words), fx.fixture_vocab(words)).summary
    by_mode = {r.mode: (r.types, r.occ) for r in df.groupBy("mode").agg(
        F.count(F.lit(1)).alias("types"), F.sum("count").alias("occ")).collect()}
    assert by_mode == {"prefix": (24, 33), "suffix": (57, 76), "both": (5, 5)}


def test_plan_broadcasts_dictionary_and_keeps_rules_jvm_side(spark):
    plan = E.queries()["analyses"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert os.path.exists(spark.sparkContext.getCheckpointDir().replace("file:", ""))
