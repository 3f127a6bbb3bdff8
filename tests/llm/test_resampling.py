import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wordform.llm import resampling as rs
from wordform.llm.common import ALNUM, Words, text_buffer
from wordform.llm.order import numbered
from wordform.llm.resampling import OP12_SQL, cutoff, op12_resampling, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def buckets_of(text, n, buckets):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, n, buckets, min_words, percent):
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for b in buckets_of(text, n, buckets):
            s[b] += 1
    for _, text in target:
        for b in buckets_of(text, n, buckets):
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        f = buckets_of(text, n, buckets)
        h = None if i is None else int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        score = None if h is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(words(text)), len(f), weight, score, None])
    may = sorted((r for r in rows if r[1] >= min_words and r[4] is not None), key=lambda r: (-r[4], r[0], r[2]))
    for rank, r in enumerate(may[: percent * len(may) // 100], 1):
        r[5] = rank
    return sorted((tuple(r) for r in rows), key=str)


def got(spark, docs, target, n, buckets, min_words, percent):
    d = spark.createDataFrame([(i, t, 1, "x", 2.0) for i, t in docs], "doc_id long, text string, score int, row string, rank double")
    b = spark.createDataFrame(target, "item_id long, text string")
    out = resample(d.repartition(3), b, n=n, buckets=buckets, min_words=min_words, percent=percent)
    return sorted((tuple(r) for r in out.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


def fixture(seed):
    rng = random.Random(seed)
    vocab = ["a", "Bb", "ß3", "日本語", "zzz", "x" * 63, "y" * 64, "z" * 65, "w" * 300, "It", "s"]
    text = lambda m: " ".join(rng.choice(vocab) + rng.choice(["", ",", "\n"]) for _ in range(m))
    docs = [(i, text(rng.choice([0, 1, 2, 5, 20, 60]))) for i in range(80)]
    docs += [(200, None), (201, ""), (None, text(30)), (202, "--- !"), docs[5], docs[5], (5, text(9)), (7, docs[7][1])]
    return docs, [(i, text(12)) for i in range(6)] + [(None, None), (9, "")]


@pytest.mark.parametrize("seed,n,buckets,few", [(2, 1, 50, 3), (3, 3, 400, 4096)])
def test_against_brute_force(spark, monkeypatch, seed, n, buckets, few):
    monkeypatch.setattr(rs, "FEW_KEYS", few)
    docs, target = fixture(seed)
    assert got(spark, docs, target, n, buckets, 2, 40) == brute(docs, target, n, buckets, 2, 40)


def test_empty_tables(spark):
    docs, target = fixture(7)
    assert got(spark, [], target, 1, 50, 0, 50) == []
    assert got(spark, docs, [], 1, 50, 0, 50) == brute(docs, [], 1, 50, 0, 50)
    few = [(1, "one two"), (2, None)]
    assert got(spark, few, target, 1, 50, 2, 50) == brute(few, target, 1, 50, 2, 50)


def test_sql(spark, oracle):
    oracle(op12_resampling, OP12_SQL)


def test_pieces_of_a_long_text_hold_each_word_once(spark, monkeypatch):
    monkeypatch.setattr(rs, "CHUNK_BYTES", 64)
    rng = random.Random(1)
    text = " ".join("v" * rng.choice([1, 5, 70, 200, 1000]) + str(rng.randrange(50)) for _ in range(300))
    column = pa.array(["a b", text, None, "c" * 500, text + "!"])
    found = [[] for _ in range(5)]
    for first, rows, w in rs._pieces(column, 1):
        for b, at in rs.run_buckets(w, 1, 1000):
            for x, i in zip(b.tolist(), at.tolist()):
                found[first + i].append(x)
        assert len(w.ptr) == rows + 1
    assert found == [buckets_of(t, 1, 1000) for t in column.to_pylist()]


def test_crc_equals_zlib():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aé日9") for _ in range(rng.choice([1, 3, 20, 31, 33, 100, 400]))) for _ in range(300)]
    data, offsets = text_buffer(pa.array([" ".join(texts)]))
    w = Words(data, offsets, ALNUM)
    state = rs.crc_feed(np.full(len(texts), 0xFFFFFFFF, np.uint32), w.data, w.starts, w.ends)
    assert (state ^ np.uint32(0xFFFFFFFF)).tolist() == [zlib.crc32(t.encode()) for t in texts]


@pytest.mark.parametrize("parts", [1, 7])
def test_every_cutoff_is_exact(spark, monkeypatch, parts):
    """Uneven slices and many equal scores; every k from first to last."""
    monkeypatch.setattr(rs, "FEW_KEYS", 4)
    rows = spark.range(0, 60, 1, parts).select(
        ((F.col("id") * 7919) % 11).alias("score"), ((F.col("id") * 31) % 20).alias("doc_id"), (F.col("id") % 2).alias("n_features"), F.col("id").alias("row")
    ).where("row < 40 or row % 3 = 0")
    keys = sorted((-r.score, r.doc_id, r.n_features, r.row) for r in rows.collect())
    for k in (1, 2, len(keys) // 2, len(keys) - 1, len(keys)):
        c = cutoff(rows, k)
        assert (-c["score"], c["doc_id"], c["n_features"], c["row"]) == keys[k - 1]
    assert cutoff(rows, 0) is None and cutoff(rows, len(keys) + 1) is None


def test_numbered(spark):
    rows = spark.range(0, 500, 1, 6).select(((F.col("id") * 7919) % 500).alias("v"))
    assert sorted((r.v, r.rank) for r in numbered(rows, F.col("v").desc()).collect()) == [(499 - i, i + 1) for i in reversed(range(500))]
    assert numbered(rows.where("v < 0"), "v").collect() == []
