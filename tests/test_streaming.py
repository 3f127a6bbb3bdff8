"""Counts merged while months arrive."""

import glob
import os
import tempfile

from tests.conftest import SF_SMALL
from wordform.plans import harness as H
from wordform.sources import fixtures as fx
from wordform.streaming.increment import merged_counts, merged_derivatives, stream_counts


def _rows(df):
    return sorted(map(str, df.collect()))


def test_a_batch_that_runs_again_counts_nothing_twice(spark):
    german, res = H._inputs(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="wf-merge-")
    fx.write_dumps(spark, german, f"{root}/in", range(1, 4))
    run = lambda: stream_counts(spark, f"{root}/in", res, f"{root}/state", filtered=True, max_files_per_trigger=2)
    run().awaitTermination()
    first = _rows(merged_counts(spark, f"{root}/state"))
    assert first
    # the last batch's commit is lost, as if the driver had died before it
    last = max((int(os.path.basename(p)) for p in glob.glob(f"{root}/state/commits/[0-9]*")), default=0)
    assert last >= 1
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{root}/state/commits/{name}"):
            os.remove(f"{root}/state/commits/{name}")
    run().awaitTermination()
    assert _rows(merged_counts(spark, f"{root}/state")) == first
    # started again without a new month: nothing changes
    run().awaitTermination()
    assert _rows(merged_counts(spark, f"{root}/state")) == first
    fx.add_dumps(spark, f"{root}/in", range(4, 13))
    run().awaitTermination()
    assert _rows(merged_derivatives(spark, f"{root}/state", res).select(*H.SUMMARY_COLS)) == _rows(H.q_month_merge(spark, SF_SMALL).select(*H.SUMMARY_COLS))


def test_a_vocabulary_beyond_the_bounds_is_met_by_counted_tokens(spark):
    german, res = H._inputs(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="wf-merge-")
    fx.write_dumps(spark, german, f"{root}/in")
    forced = H._forced(spark, SF_SMALL)
    stream_counts(spark, f"{root}/in", forced, f"{root}/state", filtered=True).awaitTermination()
    assert _rows(merged_derivatives(spark, f"{root}/state", forced).select(*H.SUMMARY_COLS)) == _rows(H.q_month_merge(spark, SF_SMALL).select(*H.SUMMARY_COLS))


def test_comments_are_filtered_on_their_way(spark):
    _, res = H._inputs(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="wf-merge-")
    fx.write_dumps(spark, fx.comments(spark, SF_SMALL), f"{root}/in")
    stream_counts(spark, f"{root}/in", res, f"{root}/state", fx.fixture_communities(spark)).awaitTermination()
    got = {r.token: r["count"] for r in merged_counts(spark, f"{root}/state").collect()}
    c = fx.comments(spark, SF_SMALL).selectExpr("cast(doc_id as string) as id", "subreddit", "body")
    kept = H.filter_comments(c, fx.fixture_communities(spark))
    want = H.an.gated_counts(H.tokens(H.sentences(kept, ["id"], "body"), ["id"]), res)
    assert got == {r.token: r["count"] for r in want.collect()} != {}
