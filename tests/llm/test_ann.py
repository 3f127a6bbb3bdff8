import numpy as np

from wordform.llm.ann import build, op5_nearest, search

SF = "/root/testdata/sf0.1"


def exact(ids, x, key, point, k):
    d = np.sqrt(((x - point) ** 2).sum(1))
    rows = [(float(s), int(i)) for i, s in zip(ids, d) if i != key]
    return sorted({i: (s, i) for s, i in sorted(rows, reverse=True)}.values())[:k]


def test_recall_of_the_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    got = {}
    for r in op5_nearest(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"], r["rank"]))
    hit = total = 0
    for i in np.flatnonzero(ids % 100 == 0):
        want = exact(ids, x, ids[i], x[i], 10)
        mine = got[ids[i]]
        assert [r for _, _, r in mine] == list(range(1, 11)) and sorted(mine) == mine
        by = dict(zip(ids.tolist(), np.sqrt(((x - x[i]) ** 2).sum(1))))
        assert all(by[v] == s for s, v, _ in mine)
        hit += len({v for _, v in want} & {v for _, v, _ in mine})
        total += len(want)
    assert hit / total >= 0.9


def test_small_and_odd_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [1.0, 0.0]), (3, [0.0, 1.0]), (2, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0])]
    rows += [(8, [None, 1.0]), (None, [1.0, 1.0]), (9, []), (200, [1.0, 2.0, 3.0]), (3, [0.0, 1.0]), (10, [5.0, 5.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    index, forest = build(df)
    got = {}
    for r in search(index, forest, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    half = round(2**0.5, 9)
    far = round((16 + 25) ** 0.5, 9)
    assert got == {0: [(1, 0.0), (100, 0.0), (2, half), (3, half), (10, far)], 100: [(0, 0.0), (1, 0.0), (2, half), (3, half), (10, far)]}


def test_one_very_common_vector(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [0.5, 0.5, 0.1]) for i in range(6000)] + [(i, rng.normal(size=3).tolist()) for i in range(6000, 9000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    index, forest = build(df)
    got = search(index, forest, df.where("vec_id = 5900")).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(i, 0.0) for i in range(10)]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    index, forest = build(df)
    assert search(index, forest, df).count() == 0
