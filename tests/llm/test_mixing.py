import random
import re

import pytest
from pyspark.sql import functions as F

from wordform.llm.mixing import OP13_SQL, mix, op13_mixing, with_copies, with_targets
from wordform.operators import joins


def targets(sizes, weights, total, cap=3):
    """Water-filling by bisection."""
    lo, hi = 0.0, total + 1.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(mid * w, cap * s) for s, w in zip(sizes, weights)) < total else (lo, mid)
    return [min(lo * w, cap * s) for s, w in zip(sizes, weights)]


def table_of(spark, docs):
    rows = [(i, t, s, 1, "x", 2.0) for i, t, s in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, sid string, w double")


def rows_of(spark, docs, **kw):
    return [tuple(r) for r in mix(table_of(spark, docs), **kw).select("doc_id", "source", "size", "source_size", "target", "copies", "taken").collect()]


def fixture(seed, sources=7, docs=400):
    rng = random.Random(seed)
    names = ["", "Z", "a", "é", "日", None, "😀", "￿", "b", "c"][:sources]
    out = []
    for i in range(docs):
        m = rng.choice([0, 1, 3, 10, 30, 200]) if i % 97 else 900
        out.append((i, " ".join(["w"] * m) if i % 50 else None, rng.choice(names + names[:1] * 4)))
    return out + [(None, "a b c", "a")] * 5 + [out[3]] * 5


def test_targets_sizes_and_limits(spark):
    docs = fixture(1)
    rows = rows_of(spark, docs)
    assert sorted(map(str, ((i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in docs))) == sorted(str(r[:3]) for r in rows)
    by = {}
    for i, source, size, source_size, target, copies, taken in rows:
        assert taken == copies * size and 0 <= copies <= 3
        x = by.setdefault(source, [0, 0, source_size, target])
        x[0] += size
        x[1] += taken
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None] * (None in by)
    want = targets([by[s][0] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))], sum(x[0] for x in by.values()))
    for s, w in zip(names, want):
        size, taken, source_size, target = by[s]
        assert size == source_size and target == pytest.approx(w, rel=1e-9, abs=1e-6)
        assert abs(taken - target) <= 0.04 * target + 1
    assert sum(x[3] for x in by.values()) == pytest.approx(sum(x[0] for x in by.values()))


def test_reruns_and_layouts_agree(spark, monkeypatch):
    docs = fixture(3)
    first = sorted(map(str, rows_of(spark, docs)))
    # other partitions, and shuffle joins instead of broadcasts
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 1)
    d = table_of(spark, docs).repartition(5, "text")
    assert sorted(str(tuple(r)) for r in mix(d).select("doc_id", "source", "size", "source_size", "target", "copies", "taken").collect()) == first


def test_copies_meet_the_target(spark):
    rows = spark.createDataFrame([(1, 100.0, 5, 50), (1, 100.0, 2, 20), (1, 100.0, 1, 3), (2, 219.0, 5, 50), (2, 219.0, 2, 20), (2, 219.0, 1, 3), (3, 7.0, 4, 80)], "sid long, target double, w long, words long")
    out = with_copies(rows).join(rows, ["sid", "w"]).groupBy("sid").agg(F.sum((F.col("copies") + F.col("p")) * F.col("words")).alias("e"), F.max("target").alias("t")).collect()
    assert all(r.e == pytest.approx(r.t) for r in out) and len(out) == 3


def test_targets_of_a_hot_source(spark):
    s = spark.createDataFrame([("a", 1), ("b", 1000), ("c", 2), ("d", 0)], "source string, source_size long")
    out = {r.source: (r.sid, r.target) for r in with_targets(s).collect()}
    assert out["a"] == (1, 3.0) and out["c"] == (3, 6.0) and out["d"] == (4, 0.0) and out["b"] == (2, 994.0)


def test_empty_tables(spark):
    assert rows_of(spark, []) == []
    assert rows_of(spark, [(1, None, None), (2, " ", "a")]) in ([(1, None, 0, 0, 0.0, 0, 0), (2, "a", 0, 0, 0.0, 0, 0)], [(2, "a", 0, 0, 0.0, 0, 0), (1, None, 0, 0, 0.0, 0, 0)])
    assert rows_of(spark, [(1, "a " * 300_000, "x")]) == [(1, "x", 300_000, 300_000, 300_000.0, 1, 300_000)]  # a very long text


def test_sql(spark, oracle):
    oracle(op13_mixing, OP13_SQL)
