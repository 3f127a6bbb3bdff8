"""All stages end to end on monthly NDJSON dumps made from the supplied
documents, the streaming comment filter, and the corpus writer."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wordform import PREFIX_FILE, SUFFIX_FILE
from wordform.sources import fixtures as fx


def _write_dumps(spark, root):
    """Two monthly dumps of the sf0.001 documents (all languages); the first
    month also holds a malformed line."""
    docs = fx.documents(spark, SF_SMALL).select("doc_id", "source", "text").orderBy("doc_id").collect()
    os.makedirs(root, exist_ok=True)
    for i, name in enumerate(["RC_2019-11", "RC_2019-12"]):
        with open(os.path.join(root, name), "w", encoding="utf-8") as fh:
            for r in docs[i::2]:
                fh.write(json.dumps({"id": str(r.doc_id), "subreddit": r.source, "body": r.text}) + "\n")
            if i == 0:
                fh.write("{broken\n")


def _write_fixture_inputs(spark, root):
    words = fx.word_counts(fx.german_comments(spark, SF_SMALL))
    lex = fx.fixture_lexicon(words).orderBy("word").collect()
    with open(os.path.join(root, "lexicon.tsv"), "w", encoding="utf-8") as fh:
        for r in lex:
            fh.write(f"{r.word}\t{r.base}\t{r.pos}\t{r.frequency}\n")
    with open(os.path.join(root, "vocab.txt"), "w", encoding="utf-8") as fh:
        for r in fx.fixture_vocab(words).collect():
            fh.write(r.token + "\n")
    with open(os.path.join(root, "communities.txt"), "w", encoding="utf-8") as fh:
        fh.write("\n".join(f"src{i}" for i in range(20)) + "\n")


def test_run_corpus_end_to_end(spark):
    from wordform.plans.stages import run_corpus

    root = tempfile.mkdtemp(prefix="wf-e2e-")
    _write_dumps(spark, f"{root}/dumps")
    _write_fixture_inputs(spark, root)
    out = f"{root}/out"
    progress = run_corpus(spark, f"{root}/dumps", f"{root}/communities.txt", PREFIX_FILE, SUFFIX_FILE,
                          f"{root}/lexicon.tsv", f"{root}/vocab.txt", out)
    assert progress["comments"]["rows"] == 201 and progress["comments"]["corrupt"] == 1
    assert 0 < progress["kept"]["rows"] < 200
    filtered = spark.read.text(f"{out}/filtered")
    assert set(r.month for r in filtered.select("month").distinct().collect()) == {11, 12}
    monthly = spark.read.parquet(f"{out}/derivatives")
    joined = spark.read.parquet(f"{out}/joined")
    assert monthly.agg(F.sum("count")).first()[0] == joined.agg(F.sum("count")).first()[0] > 0
    assert joined.groupBy("token", "affix", "base", "in_lexica", "stem", "mode").count().where("count > 1").count() == 0
    prod = spark.read.option("header", True).csv(f"{out}/productivity")
    assert set(prod.columns) >= {"affix", "v", "n", "abshapax", "mode"}
    corpus = spark.read.parquet(f"{out}/corpus")
    assert set(r.condition for r in corpus.select("condition").distinct().collect()) == {"shared", "split_base", "split_stem"}
    contexts = spark.read.parquet(f"{out}/contexts")
    shared = corpus.where("condition = 'shared'")
    # every occurrence appears once per bin of its derivative in SHARED
    assert shared.count() >= contexts.count()


def test_streaming_filter(spark):
    from wordform.sources.lists import communities_from_lines
    from wordform.streaming.increment import stream_filter_comments

    root = tempfile.mkdtemp(prefix="wf-stream-")
    _write_dumps(spark, f"{root}/in")
    comm = communities_from_lines(spark.createDataFrame([(f"src{i}",) for i in range(20)], "value string"))
    q = stream_filter_comments(spark, f"{root}/in", comm, f"{root}/out", f"{root}/ckpt")
    q.awaitTermination(300)
    got = spark.read.parquet(f"{root}/out")
    from wordform.plans.stages import filter_comments
    from wordform.sources.comments import read_comments

    batch = filter_comments(read_comments(spark, f"{root}/in"), comm)
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in batch.collect())
    assert got.count() > 0


def test_contexts_are_the_same_at_every_bound(spark):
    """Also with repeated and null ids: one context per occurrence."""
    from wordform.plans import harness as H

    german = H.stand_ins(spark, SF_SMALL).german
    odd = german.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("doc_id") % 4))
    for docs in (german, odd.unionByName(odd.limit(5))):
        runs = [H._derivatives(spark, SF_SMALL, docs=docs, max_broadcast_rows=n) for n in (2_000_000, 20, 0)]
        rows = [sorted(map(repr, r.long.collect())) for r in runs]
        assert len(rows[0]) == runs[0].summary.agg(F.sum("count")).first()[0] > 0
        assert rows[0] == rows[1] == rows[2]


def test_shuffled_contexts_move_possible_tokens_only(spark):
    from wordform.plans import harness as H

    plan = H._derivatives(spark, SF_SMALL, max_broadcast_rows=20).long._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            below = plan[plan.index(line) :][:4000]
            assert "sentence" not in below.split("Scan", 1)[0] or "_words" in below


def test_merged_contexts_count_whole_analyses(spark):
    from wordform.operators.corpus import wide_contexts

    schema = "month int, doc_id long, sent_pos int, tok_pos int, token string, affix string, base string, in_lexica boolean, stem string, mode string, context string"
    rows = [(m, 1, 0, m, "unklar", "un", None, False, "klar", "prefix", f"c{m}") for m in (1, 2, 3)] + [(1, 1, 0, 9, "frei", "x", "b", True, None, "suffix", "d")]
    keys = ["month", "doc_id", "sent_pos", "tok_pos"]
    long = spark.createDataFrame(rows, schema)
    got = {r.token: (r["count"], r.part_count, r.n_parts, r.context) for r in wide_contexts(long, keys).collect()}
    assert got == {"unklar": (3, 3, 1, ["c1", "c2", "c3"]), "frei": (1, 1, 1, ["d"])}
    parts = [r for r in wide_contexts(long, keys, max_per_row=1).collect() if r.token == "unklar"]
    assert all((r["count"], r.n_parts) == (3, 3) for r in parts) and sum(r.part_count for r in parts) == 3


def test_whole_tables_are_replaced(spark):
    from wordform import sinks

    out = tempfile.mkdtemp(prefix="wf-whole-")
    corpus = spark.createDataFrame([("shared", "prefix", 1, "train", "a"), ("shared", "prefix", 1, "test", "b")], "condition string, mode string, bin int, split string, token string")
    prod = spark.createDataFrame([("prefix", "un", 1, 2, 0), ("suffix", "ung", 2, 3, 1)], "mode string, affix string, v long, n long, abshapax long")
    for c, p in ((corpus, prod), (corpus.limit(1), prod.limit(1)), (corpus.where("split = 'test'"), prod.where("mode = 'suffix'"))):
        sinks.write_corpora(c, f"{out}/c")
        sinks.write_productivity(p, f"{out}/p")
    assert [(r.split, r.token) for r in spark.read.parquet(f"{out}/c").collect()] == [("test", "b")]
    assert [r.affix for r in spark.read.option("header", True).csv(f"{out}/p").collect()] == ["ung"]


def test_scope_deletes_its_own_tables_only(spark):
    import pytest

    from wordform.session import cut_lineage, cut_scope

    df = spark.range(3)
    kept = cut_lineage(df)
    with pytest.raises(ZeroDivisionError), cut_scope(spark):
        gone = cut_lineage(df)
        1 / 0
    assert kept.count() == 3
    with pytest.raises(Exception):
        gone.count()


def test_sink_overwrites_only_written_months(spark):
    from wordform.sinks import write_derivatives

    out = tempfile.mkdtemp(prefix="wf-sink-") + "/t"
    rows = [("a", 2019, 1, 1), ("b", 2019, 2, 2)]
    write_derivatives(spark.createDataFrame(rows, "token string, year int, month int, count long"), out)
    write_derivatives(spark.createDataFrame([("c", 2019, 2, 5)], "token string, year int, month int, count long"), out)
    got = sorted((r.token, r.month) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1), ("c", 2)]
