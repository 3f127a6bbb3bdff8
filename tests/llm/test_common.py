import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wordform.llm.common import ALNUM, CHUNK_BYTES, HASH_BLOCK, NON_SPACE, Words, fold, map_text, shingle_hashes, text_buffer, text_ranges, without

ALNUM_RE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE_RE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_words_equal_the_expressions():
    rng = random.Random(1)
    pool = list("aZ09 \t\n\x0b\x0c\r\x1c\x85.,_É中😀ß") + ["word", "  "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(400)] + [None, ""]
    data, offsets = text_buffer(pa.array(texts))
    for member, pattern in ((ALNUM, ALNUM_RE), (NON_SPACE, SPACE_RE)):
        w = Words(data, offsets, member)
        for t, a, b in zip(texts, w.ptr[:-1].tolist(), w.ptr[1:].tolist()):
            assert w.words(a, b) == pattern.findall(lower(t or ""))


def test_hashes_follow_the_words():
    texts = ["one Two three one", "three", "", "twothree", "two three"]
    data, offsets = text_buffer(pa.array(texts))
    w = Words(data, offsets, ALNUM)
    of = {}
    for word, h in zip(w.words(0, len(w.starts)), w.hashes().tolist()):
        assert of.setdefault(word, h) == h
    assert len(set(of.values())) == len(of)
    # the same text further back in a buffer hashes alike
    data, offsets = text_buffer(pa.array(["x" * 5000, "one"]))
    assert Words(data, offsets, ALNUM).hashes()[1] == of["one"]
    h = np.arange(9, dtype=np.uint64)
    s = shingle_hashes(h, 3)
    assert len(s) == 7 == len(set(s.tolist())) and len(shingle_hashes(h[:2], 3)) == 0
    assert shingle_hashes(h[2:5], 3)[0] == s[2] != shingle_hashes(h[2:4], 2)[0]


def test_ranges_cover_all_rows():
    offsets = np.cumsum([0, 3, 0, 50, 1, 1, 1, 200, 2, 0])
    ranges = list(text_ranges(offsets, 10))
    assert ranges[0][0] == 0 and ranges[-1][1] == 9 and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    assert all(b - a == 1 or offsets[b] - offsets[a] <= 10 for a, b in ranges)


def test_fold_is_zlib_crc32(spark):
    ids = [0, 1, -5, 123456789012]
    got = {r["id"]: r["f"] for r in spark.createDataFrame([(i,) for i in ids] + [(None,)], "id long").select("id", fold("id", 5).alias("f")).collect()}
    assert got == {**{i: zlib.crc32(str(i).encode()) % 5 for i in ids}, None: None}


def test_map_text_keeps_rows_and_slices_texts(spark):
    df = spark.createDataFrame([(i, "x" * (CHUNK_BYTES // 3), "k") for i in range(7)] + [(None, None, None)], "id long, text string, n string")

    def make():
        return lambda t: {"length": pa.array([0 if x is None else len(x) for x in t.to_pylist()], pa.int64()), "slice": pa.array([len(t)] * len(t), pa.int64())}

    rows = map_text(df.coalesce(1), ["id", "n"], make, "length bigint, slice bigint").collect()
    assert sorted((r["id"] is None, r["id"] or 0, r["n"], r["length"]) for r in rows) == [*((False, i, "k", CHUNK_BYTES // 3) for i in range(7)), (True, 0, None, 0)]
    assert max(r["slice"] for r in rows) <= 4


def test_without(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "_id long, t string")
    keys = spark.createDataFrame([("b",), ("b",), (None,)], "key string")
    assert sorted(r["t"] for r in without(df, keys, F.col("t"), "key").collect()) == ["a", "c"]
    assert [r["t"] for r in without(df, keys, F.col("t"), "key", keep=True).collect()] == ["b", "b"]


def test_without_keeps_columns_of_any_name(spark):
    from pyspark.sql import functions as F

    from wordform.llm.common import without

    df = spark.createDataFrame([(1, "a", "b", "c", "d"), (2, "e", "f", "g", "h")], "doc_id int, _own string, _key string, __own string, _mine string")
    keys = spark.createDataFrame([("1",), ("1",), ("7",)], "k string")
    assert [tuple(r) for r in without(df, keys, F.col("doc_id").cast("string"), "k").collect()] == [(2, "e", "f", "g", "h")]
    kept = without(df, keys, F.col("doc_id").cast("string"), "k", keep=True)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, "a", "b", "c", "d")]


def test_hashes_over_several_blocks():
    """Texts and words longer than a block hash like short ones."""
    long = "x" * (2 * HASH_BLOCK + 17)
    texts = ["one two", "some words and one two " * 60000, f"one {long} two", long, long[1:]]
    data, offsets = text_buffer(pa.array(texts))
    w = Words(data, offsets, ALNUM)
    h = w.hashes()
    one, two = h[:2]
    of = [h[a:b] for a, b in zip(w.ptr[:-1], w.ptr[1:])]
    assert (of[1].reshape(-1, 5)[:, 3:] == [one, two]).all() and len(set(of[1].tolist())) == 5
    assert of[2][0] == one and of[2][2] == two and of[2][1] == of[3][0] != of[4][0]
    assert (Words(*text_buffer(pa.array(texts[1:2])), ALNUM).hashes() == of[1]).all()
