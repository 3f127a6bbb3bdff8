import numpy as np
from pyspark.sql import functions as F

from wordform.llm import langid
from wordform.llm.langid import LEAST_DOCS, LENGTH, PAD, Net, fit, identify, op10_language, score_windows, train

SF = "/root/testdata/sf0.01"


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    net = Net(3, rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(1, 256, (4, LENGTH + PAD)), np.array([0, 1, 2, 1])
    _, g = net.loss_gradient(x, y)
    for name in net.p:
        flat, grad = net.p[name].reshape(-1), g[name].reshape(-1)
        for i in np.argsort(-np.abs(grad))[:3]:
            old, h = flat[i], 1e-6
            flat[i] = old + h
            up = net.loss_gradient(x, y)[0]
            flat[i] = old - h
            down = net.loss_gradient(x, y)[0]
            flat[i] = old
            assert abs((up - down) / (2 * h) - grad[i]) < 1e-4 * max(1, abs(grad[i]))


def test_folded_filters_equal_the_network():
    rng = np.random.default_rng(1)
    net = Net(4, rng)
    x = rng.integers(0, 256, (5, LENGTH + PAD)).astype(np.uint8)
    folded = score_windows(net.tables(), x)
    y = np.zeros(5, int)
    for c in range(4):
        loss = [net.loss_gradient(x[i : i + 1], y[:1] + c)[0] for i in range(5)]
        assert np.allclose(np.exp(-np.array(loss)), folded[:, c], atol=1e-4)


def test_learns_two_alphabets():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(97, 105, (60, LENGTH + PAD)), rng.integers(105, 113, (60, LENGTH + PAD))]).astype(np.uint8)
    y = np.repeat([0, 1], 60)
    got = score_windows(train(x, y, 2, steps=60).tables(), x).argmax(1)
    assert (got == y).mean() == 1.0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = op10_language(spark, SF).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null")
    right, n, low, high = rows.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 200 and right / n >= 0.97 and low >= 0 and high <= 1


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (None, "the of and to"), (4, "é"), (5, "中"), (1, None), (6, "the cat " * 60000)]
    df = spark.createDataFrame([(i, t, "x", 0.5) for i, t in rows], "doc_id long, text string, lang_pred string, score double")
    none = {(r["doc_id"], r["lang_pred"], r["score"]) for r in identify(df, None, ["doc_id"]).collect()}
    assert none == {(i, "und", 0.0) for i, _ in rows}
    model = fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "text", "lang")
    got = identify(df, model, ["doc_id"]).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by[1] == by[2] == by[3] == "und" and by[4] in model[0] and by[5] in model[0] and by[6] in model[0]
    assert fit(df.withColumn("lang", F.lit(None).cast("string")), "text", "lang") is None
    assert identify(df.limit(0), model, ["doc_id"]).count() == 0


def test_every_language_is_learned(spark, monkeypatch):
    """300 languages: one with most rows, all copies of one text, one with a single text."""
    seen = {}

    def recorded(x, y, classes, seed, steps):
        seen.update(x=x, y=y, classes=classes, steps=steps)
        return Net(classes, np.random.default_rng(0))

    monkeypatch.setattr(langid, "train", recorded)
    few = spark.range(298 * 60).select((F.col("id") % 298).alias("k"), "id")
    rows = few.select(F.format_string("l%03d", "k").alias("lang"), F.format_string("text %d of language %d", "id", "k").alias("text"))
    rows = rows.union(spark.range(20000).select(F.lit("copies"), F.lit("the same text again")))
    rows = rows.union(spark.range(1).select(F.lit("single"), F.lit("only this")))
    langs, _ = fit(rows, "text", "lang")
    assert len(langs) == seen["classes"] == 300
    n = np.bincount(seen["y"], minlength=300)
    assert n[langs.index("copies")] == n[langs.index("single")] == 1
    assert n.min() == 1 and 4 <= np.sort(n)[2] and n.max() < 3 * LEAST_DOCS and seen["steps"] > langid.STEPS


def test_windows_of_a_long_text_are_made_in_turn(spark):
    """One text of 8 MB takes no multiple of its size in windows."""
    import tracemalloc

    import pyarrow as pa

    model = (["a", "b"], Net(2, np.random.default_rng(3)).tables())
    made = []
    whole = langid.map_text
    langid.map_text = lambda docs, keep, make, schema, text: made.append(make)
    try:
        identify(spark.createDataFrame([], "doc_id long, text string"), model, ["doc_id"])
    finally:
        langid.map_text = whole
    size = 8 << 20
    texts = pa.array(["words of a text " * (size // 16)])
    run = made[0]()
    tracemalloc.start()
    got = run(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got["lang_pred"][0].as_py() in "ab" and peak < 4 * size
