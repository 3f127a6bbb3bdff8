import random

import numpy as np
from pyspark.sql import functions as F

from wordform.llm.toxicity import DRIFT, fit, op8_toxicity, score, segments, word_counts


def maximal(scores):
    """Maximal scoring subsequences by their recursive definition: the best
    (shortest, leftmost) one, then those of what is left and right of it."""
    if not len(scores):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sums[j] - sums[i]
            if s > 1e-9 and (best is None or s > best[0] + 1e-9 or (abs(s - best[0]) <= 1e-9 and j - i < best[2] - best[1])):
                best = (s, i, j)
    if best is None:
        return []
    s, i, j = best
    return maximal(scores[:i]) + [(i, j, s)] + [(a + j, b + j, x) for a, b, x in maximal(scores[j:])]


def test_linear_scan_finds_all_maximal_segments():
    rng = random.Random(1)
    for _ in range(400):
        n = rng.randint(1, 25)
        at = sorted(rng.sample(range(n), rng.randint(0, n)))
        scores = [rng.choice([3.1, 1.23, 0.77, -0.9, -2.3]) + rng.random() / 100 for _ in at]
        full = [-DRIFT] * n
        for p, s in zip(at, scores):
            full[p] = s
        # ends of segments at neutral words never help, so equal scores can't make two answers
        got = segments(np.array(scores), np.array(at, int))
        want = maximal(np.array(full))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for _, _, s in got], [s for _, _, s in want])


def test_word_counts(spark):
    df = spark.createDataFrame([("A b b", 1), ("b", 0), (None, 1), ("", 0)], "text string, label int")
    assert {(r["word"], r["n"]) for r in word_counts(df).collect()} == {("a", 1), ("b", 3)}
    assert {(r["word"], r["kind"], r["n"]) for r in word_counts(df, "label").collect()} == {("a", 1, 1), ("b", 1, 1), ("b", 0, 1)}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op8_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("toxic is not null")
    hit, toxic, right, n = rows.agg(
        F.count_if((F.col("toxic") == 1) & (F.col("predicted") == 1)), F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == F.col("predicted")), F.count("*")
    ).first()
    assert n > 500 and hit / toxic >= 0.88 and right / n >= 0.96


def test_edges(spark):
    clean = ["the cat sat on the mat today %d" % i for i in range(40)]
    bad = ["the cat %d is vile scum vile scum today" % i for i in range(40)]
    rows = [(i, t, 0) for i, t in enumerate(clean)] + [(100 + i, t, 1) for i, t in enumerate(bad)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = fit(sample, sample)
    df = spark.createDataFrame([(1, None, 9.0), (2, "", 9.0), (3, "?!", 9.0), (None, "vile scum", 9.0), (4, "the cat " * 50000 + "vile scum vile scum", 9.0), (2, "", 9.0)], "doc_id long, text string, score double")
    got = score(df, model, ["doc_id"]).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 6 and by[1]["score"] == by[2]["score"] == by[3]["score"] < 0.5
    assert by[None]["score"] > 0.5
    first = by[4]["passages"][0]
    assert (first["first"], first["stop"]) == (100000, 100004)
    assert fit(sample.where("label = 0"), sample) is None
    assert {r["score"] for r in score(df, None, ["doc_id"]).collect()} == {0.0}
    assert score(df.limit(0), model, ["doc_id"]).count() == 0
