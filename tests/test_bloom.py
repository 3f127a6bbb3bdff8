"""The Bloom filter table, and the vocabulary gate built on it."""

import re

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wordform.operators import analyze as an
from wordform.operators.bloom import BITS_PER_KEY, BLOCK_BITS, BloomFilter
from wordform.plans import harness as H


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_key_is_missed_and_few_others_pass(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("word"))
    bloom = BloomFilter.of(keys.unionByName(spark.sql("select cast(null as string) as word")), 20_000)
    probed = bloom.probed(keys, F.col("word"), "hit")
    assert probed.columns == ["word", "hit"] and probed.where("not hit").isEmpty()
    others = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("word"))
    assert bloom.probed(others, F.col("word")).where("may_be_in").count() < 1000
    assert bloom.table.count() <= -(-20_000 * BITS_PER_KEY // BLOCK_BITS)


def test_of_nothing_and_null_keys(spark):
    none = spark.createDataFrame([], "word string")
    words = spark.createDataFrame([("a",), (None,)], "word string")
    assert [r.may_be_in for r in BloomFilter.of(none, 0).probed(words, F.col("word")).collect()] == [False, False]
    assert sorted(map(str, BloomFilter.of(words, 2).probed(words, F.col("word")).collect())) == [
        "Row(word='a', may_be_in=True)", "Row(word=None, may_be_in=False)"
    ]


def test_probing_moves_no_rows(spark):
    bloom = BloomFilter.of(spark.range(1000).select(F.col("id").cast("string").alias("k")), 1000)
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    assert "Exchange hashpartitioning" not in _plan(bloom.probed(df, F.col("k")))


def test_one_broadcast_serves_all_probes(spark):
    types, res = H._types(spark, SF_SMALL)
    found = an.analyze(types.select("token"), resources=res, gate=False)
    found.collect()
    plan = _plan(found).split("Initial Plan")[0]
    assert len(re.findall(r"BroadcastHashJoin", plan)) >= 6 and len(re.findall(r"ReusedExchange", plan)) >= 3, plan


def test_only_counted_survivors_move(spark):
    """Beyond the bounds: tokens are counted by partial aggregation, and the exact
    join sees what the filter lets through."""
    res = H._forced(spark, SF_SMALL)
    toks = H.tokens(H.sentences(H.stand_ins(spark, SF_SMALL).german, H.KEY, "body"), H.KEY)
    gate = an.gated_counts(toks, res)
    plan = _plan(gate)
    assert "LeftAnti" in plan and "Generate" not in plan  # no tokens, only their counts
    counted = toks.groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    may = res.vocab_known.probed(counted, F.lower("token")).where("may_be_in").count()
    known = counted.join(res.dictionary.where("in_vocab"), F.lower("token") == F.col("key"), "left_semi").count()
    assert known <= may <= known + 0.1 * counted.count()
    assert sorted(map(str, gate.collect())) == sorted(map(str, H.q_vocab_gate(spark, SF_SMALL).collect()))


def test_same_analyses_beyond_the_bounds(spark):
    assert sorted(map(str, H.q_analyses_bloom(spark, SF_SMALL).collect())) == sorted(map(str, H.q_analyses(spark, SF_SMALL).collect()))


def test_contexts_are_planned_when_asked_for(spark):
    H.stand_ins(spark, SF_SMALL).derived.clear()
    H._inputs(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("summary", "summary")
    H.q_derivatives(spark, SF_SMALL)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("summary")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 5, len(jobs)
