import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from wordform.llm.bpe import Model, char_classes, decode_ids, op6_encode, round_trip  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, encoding="utf-8") as f:
        return Model(f.read(), char_classes())


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.sampled_from([" ", "  ", "<|endoftext|>", "'s", "'LL", "the", "\n\n", "\x1c", "\x85", "é", "123", "aaaa", "ʼn"])), max_size=12))
def test_ids_and_text_equal_the_library(model, parts):
    text = "".join(parts)
    ids = np.frombuffer(model.encode([text])[0], "<u4").tolist()
    assert ids == expected(text)
    assert model.decode(np.array(ids, "<u4").tobytes()) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_long_words_and_shared_prefixes(model):
    texts = ["a" * 3000, " " * 700, "ab" * 900, "é" * 400, "1" * 999, "internationalization international internat internation"]
    for text, ids in zip(texts, model.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == expected(text)


def test_any_bytes_decode_as_the_library_does(model):
    rng = np.random.default_rng(1)
    for _ in range(200):
        ids = rng.integers(0, 50257, 12)
        assert model.decode(ids.astype("<u4").tobytes()) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


def test_operator(spark):
    texts = [(1, "Hello wörld"), (2, None), (3, ""), (None, "x<|endoftext|>y"), (1, "Hello wörld"), (4, "word " * 40000)]
    df = spark.createDataFrame([(i, t, "c") for i, t in texts], "doc_id long, text string, ids string")
    rows = round_trip(df, PATH, ["doc_id"], ["ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"]).collect()
    want = []
    for i, t in texts:
        ids = expected(t or "")
        raw = np.array(ids, "<u4").tobytes()
        want.append((i, ids, len(ids), hashlib.sha256(raw).hexdigest(), t or "", hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    back = decode_ids(spark.createDataFrame([(1, expected("a b")), (2, None)], "k int, ids array<int>"), PATH)
    assert sorted((r["k"], r["decoded"]) for r in back.collect()) == [(1, "a b"), (2, None)]
    assert round_trip(df.limit(0), PATH, ["doc_id"], ["n_tokens"]).count() == 0


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_encode(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = expected(texts[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
