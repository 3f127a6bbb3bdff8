"""Physical-plan properties the scale design relies on."""

import re

from tests.conftest import SF_SMALL
from wordform.operators import analyze as an
from wordform.plans import harness as H


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition", plan))


def test_analysis_has_one_shuffle(spark):
    types, res = H._types(spark, SF_SMALL)
    plan = _plan(an.analyze(types, resources=res))
    # only the token count shuffles; affix grouping and the choice reuse it
    assert _shuffles(plan) == 1, plan
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_long_table_moves_no_text(spark):
    r = H._derivatives(spark, SF_SMALL)
    plan = _plan(r.long)
    assert _shuffles(plan) == 0, plan
    assert "BroadcastHashJoin" in plan
    assert "ReadSchema: struct<doc_id:bigint,body:string>" in r.long._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_derivatives_take_few_jobs(spark):
    H.stand_ins(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("derivatives", "derivatives")
    H.q_derivatives(spark, SF_SMALL).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("derivatives")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 10, len(jobs)


def test_long_window_lines_are_filtered_before_they_move(spark):
    import tempfile

    import zstandard

    from wordform.plans.stages import filter_comments
    from wordform.sources.comments import read_comments
    from wordform.sources.lists import communities_from_lines

    d = tempfile.mkdtemp(prefix="wf-zst-")
    with open(f"{d}/RC_2020-11.zst", "wb") as fh:
        fh.write(zstandard.ZstdCompressor().compress(b'{"id": "1", "subreddit": "de", "body": "x"}\n'))
    kept = filter_comments(read_comments(spark, d, long_window=True), communities_from_lines(spark.createDataFrame([("de",)], "value string")), spread=3)
    plan = _plan(kept)
    assert plan.index("Exchange RoundRobin") < plan.index("LeftSemi") < plan.index("BatchScan")
    assert "Exchange RoundRobin" not in plan[plan.index("LeftSemi") : plan.index("BatchScan")]


def test_scan_reads_only_needed_columns(spark):
    df = H.q_community_filter(spark, SF_SMALL)
    s = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in s


def test_no_single_partition_window_in_splits(spark):
    df = H.q_shared_split(spark, SF_SMALL)
    plan = _plan(df)
    assert "Exchange SinglePartition" not in plan
