import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wordform.llm.common import text_buffer
from wordform.llm.quality import DEPTH, FEATURES, Trees, features, op4_quality, score, train


def test_features_of_plain_texts():
    x = features(*text_buffer(pa.array(["Aa bb bb. cc\ncc!", "", None, "é"])))
    f = {name: x[:, i] for i, name in enumerate(FEATURES)}
    assert np.allclose(np.expm1(f["words"]), [5, 0, 0, 1]) and np.allclose(np.expm1(f["bytes"]), [16, 0, 0, 2])
    assert f["distinct_words"][0] == 1.0 and f["longest_word"][0] == 3
    assert np.isclose(f["upper"][0], 1 / 16) and f["distinct_lines"][0] == 1.0
    assert np.isfinite(x).all() and (x[1] == x[2]).all()


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    t = Trees(rng.integers(0, 5, (7, inner)), rng.normal(size=(7, inner)), rng.normal(size=(7, leaves)), 0.3)
    x = rng.normal(size=(40, 5))
    for row, p in zip(x, t.predict(x)):
        z = 0.3
        for k in range(7):
            i = 0
            while i < inner:
                i = 2 * i + 1 + int(row[t.feature[k, i]] > t.threshold[k, i])
            z += t.leaf[k, i - inner]
        assert np.isclose(p, 1 / (1 + np.exp(-z)))


def test_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    t = train(x[:2000], y[:2000])
    assert ((t.predict(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = op4_quality(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = rows.cache()
    assert rows.count() == docs
    held = rows.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("quality is not null")
    right, n = held.agg(F.count_if(F.col("predicted") == F.col("quality")), F.count("*")).first()
    assert n > 50 and right / n >= 0.95


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, "", 2.0), (None, "a " * 200000, 3.0), (1, None, 1.0)], "doc_id long, text string, score double")
    assert {r["score"] for r in score(df, None, ["doc_id"]).collect()} == {0.5}
    assert score(df.limit(0), None, ["doc_id"]).count() == 0
    t = train(np.random.default_rng(0).normal(size=(50, len(FEATURES))), np.arange(50) % 2 * 1.0)
    got = score(df, t, ["doc_id"]).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 for r in got)
