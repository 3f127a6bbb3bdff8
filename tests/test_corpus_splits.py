"""Merges, bins and splits: exact sizes, disjoint and complete splits,
keys that never cross splits, independence from partitioning."""

from pyspark.sql import functions as F

from wordform.operators.corpus import duplicate_analyses, merge_increment, merge_months, review_sample, wide_contexts
from wordform.operators.metrics import productivity
from wordform.operators.splits import frequency_bins, shared_split, split_by_key

SCHEMA = "token string, affix string, base string, in_lexica boolean, stem string, mode string, count long"


def _tables(spark):
    a = spark.createDataFrame([("Lieferung", "ung", "liefern", True, "Liefer", "suffix", 2),
                               ("Heiterkeit", "keit", None, False, "Heiter", "suffix", 1)], SCHEMA)
    b = spark.createDataFrame([("Lieferung", "ung", "liefern", True, "Liefer", "suffix", 3),
                               ("Heiterkeit", "keit", "heiter", False, None, "suffix", 1),
                               ("unklar", "un", None, False, "klar", "prefix", 1)], SCHEMA)
    return a, b


def test_merge_and_increment(spark):
    a, b = _tables(spark)
    m = {(r.token, r.base): r["count"] for r in merge_months([a, b]).collect()}
    assert m == {("Lieferung", "liefern"): 5, ("Heiterkeit", None): 1, ("Heiterkeit", "heiter"): 1, ("unklar", None): 1}
    inc = merge_increment(merge_months([a]), b)
    assert sorted(map(repr, inc.collect())) == sorted(map(repr, merge_months([a, b]).collect()))
    dup = duplicate_analyses(merge_months([a, b]))
    assert "orderBy" in duplicate_analyses.__code__.co_names and "Sort" in dup._jdf.queryExecution().optimizedPlan().toString()
    dup = sorted((r.token, str(r.base)) for r in dup.collect())
    assert dup == [("Heiterkeit", "None"), ("Heiterkeit", "heiter")]


def test_productivity(spark):
    a, b = _tables(spark)
    p = {(r.mode, r.affix): (r.v, r.n, r.abshapax) for r in productivity(merge_months([a, b])).collect()}
    assert p == {("suffix", "ung"): (1, 5, 0), ("suffix", "keit"): (2, 2, 2), ("prefix", "un"): (1, 1, 1)}


def test_review_sample_is_deterministic(spark):
    a, b = _tables(spark)
    m = merge_months([a, b])
    s1 = [r.token for r in review_sample(m, n=2, seed=1).collect()]
    s2 = [r.token for r in review_sample(m.repartition(3), n=2, seed=1).collect()]
    assert s1 == s2 and len(s1) == 2


def test_bins_overlap_at_64(spark):
    df = spark.createDataFrame([(1,), (3,), (64,), (65,), (1000,)], "count long")
    got = sorted((r["count"], r.bin) for r in frequency_bins(df).collect())
    assert got == [(1, 1), (3, 2), (64, 6), (64, 7), (65, 7), (1000, 8)]
    got = sorted((r["count"], r.bin) for r in frequency_bins(df, bins="disjoint").collect())
    assert (64, 6) not in got and (64, 7) in got


def _rows(spark, n=2000):
    df = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "prefix").otherwise("suffix").alias("mode"),
        F.lit(1).alias("bin"),
        F.concat(F.lit("t"), (F.col("id") % 97).cast("string")).alias("token"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("b"), (F.col("id") % 41).cast("string"))).alias("base"),
    )
    return df


def test_shared_split_sizes_exact_and_stable(spark):
    rows = _rows(spark)
    out = shared_split(rows, ["mode", "bin"], ["token", "doc_id"], seed=200)
    counts = {(r.mode, r.split): r["count"] for r in out.groupBy("mode", "split").count().collect()}
    for mode in ("prefix", "suffix"):
        n = rows.where(F.col("mode") == mode).count()
        n_train = round(0.8 * n)
        n_test = round((0.15 / (1 - 0.8)) * (n - n_train))
        assert counts[(mode, "train")] == n_train
        assert counts[(mode, "test")] == n_test
        assert counts[(mode, "dev")] == n - n_train - n_test
    assert out.count() == rows.count() and out.select("doc_id").distinct().count() == rows.count()
    again = shared_split(rows.repartition(7), ["mode", "bin"], ["token", "doc_id"], seed=200)
    a = {(r.doc_id, r.split) for r in out.collect()}
    b = {(r.doc_id, r.split) for r in again.collect()}
    assert a == b


def test_split_by_key_sizes_and_no_crossing(spark):
    rows = _rows(spark)
    out = split_by_key(rows, ["mode", "bin"], "base", seed=200)
    assert out.where(F.col("base").isNull()).count() == 0
    crossing = out.groupBy("mode", "bin", "base").agg(F.countDistinct("split").alias("k")).where("k > 1").count()
    assert crossing == 0
    for mode in ("prefix", "suffix"):
        k = rows.where(F.col("mode") == mode).select("base").distinct().count()  # null counts as one key
        keys = out.where(F.col("mode") == mode).select("base", "split").distinct()
        per = {r.split: r["count"] for r in keys.groupBy("split").count().collect()}
        null_split_missing = (int(0.8 * k) + int(0.15 * k) + (k - int(0.8 * k) - int(0.15 * k))) - sum(per.values())
        assert null_split_missing == 1  # the null key took one slot and its rows were dropped
        assert per.get("train", 0) + per.get("test", 0) + per.get("dev", 0) == k - 1


def test_wide_contexts_split_hot_tokens(spark):
    long = spark.range(25).select(
        F.lit("Lieferung").alias("token"), F.lit("ung").alias("affix"), F.lit("liefern").alias("base"),
        F.lit(True).alias("in_lexica"), F.lit("Liefer").alias("stem"), F.lit("suffix").alias("mode"),
        F.col("id").alias("doc_id"), F.lit(0).alias("sent_pos"), F.lit(0).alias("tok_pos"),
        F.concat(F.lit("ctx"), F.col("id").cast("string")).alias("context"),
    )
    w = wide_contexts(long, ["doc_id", "sent_pos", "tok_pos"], max_per_row=10).collect()
    assert 2 <= len(w) <= 3  # ceil(25 / 10) hash parts
    assert sum(r.part_count for r in w) == 25 and {(r["count"], r.n_parts) for r in w} == {(25, 3)}
    assert sorted(c for r in w for c in r.context) == sorted(f"ctx{i}" for i in range(25))
