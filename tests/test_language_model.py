"""The learned language scorer: edge rows, held-out accuracy, plan, and its use as a hook."""

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wordform.operators.filters import detect_language, lang_filter
from wordform.operators.language_model import BUCKETS, LanguageModel, buckets, language_weights
from wordform.plans.harness import HELD_OUT_EVERY
from wordform.plans.stages import filter_comments

TEXTS = [("de", "Der Hund und die Katze schlafen in der Sonne."), ("de", "Schöne Grüße aus München!"),
         ("en", "The dog and the cat are sleeping in the sun."), ("en", "Greetings from the town of Bath."), (None, "unlabelled"), ("fr", None)]


def plain_buckets(text):
    s = " " + re.sub(r"[^\W\d_]+|(.)", lambda m: " " if m.group(1) else m.group(), text.lower(), flags=re.S)
    s = re.sub(" +", " ", s + " ")
    s = "".join(c if ord(c) < 0x10000 else "\ufffd" for c in s)
    return [(ord(s[i]) * 17161 + ord(s[i + 1]) * 131 + ord(s[i + 2])) % BUCKETS for i in range(len(s) - 2)]


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(TEXTS, "lang string, text string")


@pytest.fixture(scope="module")
def documents_model(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return docs, LanguageModel.fit(docs.where(F.col("doc_id") % HELD_OUT_EVERY != 0), "text", "lang")


def test_buckets_equal_a_plain_count(spark):
    rng = random.Random(2)
    pool = list("aZäß 1.\n\té中\U00020000😀") + ["word", "  ", "Der "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(200)] + [""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", buckets(F.col("t")).alias("b")).collect()
    for r in rows:
        assert r["b"] == plain_buckets(r["t"]), repr(r["t"])


def test_weights_are_the_smoothed_shares(labelled):
    got = {(r["lang"], r["bucket"]): r["weight"] for r in language_weights(labelled, "text", "lang").collect()}
    assert len(got) == 2 * BUCKETS
    for lang in ("de", "en"):
        n = Counter(b for at, t in TEXTS if at == lang for b in plain_buckets(t))
        total = sum(n.values())
        for b in range(BUCKETS):
            assert got[lang, b] == math.floor(1000 * math.log((n[b] + 1) / (total + BUCKETS)))


def test_edges(spark, labelled, tmp_path):
    model = LanguageModel.fit(labelled, "text", "lang")
    assert model.languages == ("de", "en")
    rows = [(0, None), (1, ""), (2, "12 !? 😀"), (3, "é"), (4, "\U00020000"), (5, "die Katze"), (6, "the cat"), (6, "the cat")]
    df = spark.createDataFrame(rows, "id int, body string")
    by = {r["id"]: r["l"] for r in df.select("id", model.label(F.col("body")).alias("l")).collect()}
    assert by == {0: None, 1: None, 2: None, 3: by[3], 4: by[4], 5: "de", 6: "en"} and by[3] and by[4]
    language_weights(labelled, "text", "lang").write.parquet(f"{tmp_path}/model")
    assert LanguageModel.read(spark, f"{tmp_path}/model") == model
    nothing = LanguageModel.fit(labelled.limit(0), "text", "lang")
    assert nothing.languages == () and df.select(nothing.label(F.col("body")).alias("l")).where("l is not null").count() == 0
    with pytest.raises(ValueError):
        LanguageModel.from_weights(language_weights(labelled, "text", "lang").where("bucket > 3"))


def test_equal_sums_go_to_the_first_language(spark):
    same = spark.createDataFrame([("nl", "abc"), ("de", "abc")], "lang string, text string")
    model = LanguageModel.fit(same, "text", "lang")
    assert spark.range(1).select(model.label(F.lit("abc x")).alias("l")).first()["l"] == "de"


def test_better_than_stop_words_on_documents_not_seen(documents_model):
    docs, model = documents_model
    held = docs.where((F.col("doc_id") % HELD_OUT_EVERY == 0) & F.col("lang").isNotNull())
    both = detect_language(held.select("lang", "text", model.label(F.col("text")).alias("learned")), "text", "words")
    n, learned, words = both.agg(F.count("*"), F.count_if(F.col("learned") == F.col("lang")), F.count_if(F.col("words") == F.col("lang"))).first()
    assert learned >= words and learned / n > 0.95
    assert both.where(F.col("learned").isNull() & F.col("text").rlike(r"\p{L}")).count() == 0


def test_hook_of_the_comment_filter(spark, documents_model):
    _, model = documents_model
    rows = [("1", "src1", "Wir haben gestern lange über das Wetter gesprochen."), ("2", "src1", "We talked about the weather for a long time yesterday.")]
    df = spark.createDataFrame(rows, "id string, subreddit string, body string")
    kept = filter_comments(df, None, lang=model.languages[0], scorer=model.label)
    assert kept.count() == lang_filter(df, "body", model.languages[0], scorer=model.label).count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "EvalPython" not in plan


def test_time_grows_with_the_length_of_a_text(spark, labelled):
    model = LanguageModel.fit(labelled, "text", "lang")

    def seconds(n):
        df = spark.range(1).select(model.label(F.repeat(F.lit("ein Satz mit Wörtern "), n)).alias("l"))
        start = time.time()
        assert df.first()["l"] == "de"
        return time.time() - start

    seconds(1000)
    assert seconds(40_000) < 30


def test_a_text_is_turned_into_numbers_once(spark, documents_model):
    """No string is made per n-gram, and the weights are an array once, before any row."""
    _, model = documents_model
    df = spark.range(1).select(F.col("id").cast("string").alias("t"))
    plan = df.select(model.label(F.col("t")).alias("l"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "substring" not in plan and "from_json" not in plan
