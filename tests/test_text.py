"""Clean-up and segmentation on inline edge rows (the supplied German text
holds no URL or HTML entity)."""

from pyspark.sql import functions as F

from wordform.functions.predicates import has_digit, starts_lower, starts_upper
from wordform.functions.text import sanitize_body, sanitize_text, strip_ws
from wordform.operators.filters import detect_language
from wordform.operators.segment import sentences, tokens


def _one(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_sanitize_body(spark):
    got = _one(spark, ["a\r\nb (http://x.y/z) c", "see https://q.de/a?b=1, ok", "[deleted]"], sanitize_body)
    assert got == ["a b  c", "see  ok", "[deleted]"]


def test_sanitize_text_patterns(spark):
    rows = [
        "go to https://x.de/a and back",
        "watch v=abc&t=12s now",
        "in /r/de and /u/name",
        "und/oder. bleibt nicht",
        "Tom &amp; Jerry &lt;3 &eacute;t&eacute;",
        "line1\r\nline2",
    ]
    got = _one(spark, rows, sanitize_text)
    assert got == [
        "go to  and back",
        "watch  now",
        "in de and name",
        " bleibt nicht",
        "Tom & Jerry <3 été",
        "line1 line2",
    ]


def test_builtin_unescape_path(spark):
    got = _one(spark, ["a &amp;lt; b", "&quot;x&quot; &#39;y&#39;"], lambda c: sanitize_text(c, full_unescape=False))
    assert got == ["a &lt; b", "\"x\" 'y'"]


def test_strip_matches_python(spark):
    values = ["  x y  \n", "\x1cabc\x1f", "  ", "a​b"]
    got = _one(spark, values, strip_ws)
    assert got == [v.strip() for v in values]


def test_unicode_digits_and_case(spark):
    df = spark.createDataFrame([("abc٣",), ("Über",), ("ärger",), ("-x",)], "v string")
    rows = df.select(has_digit(F.col("v")), starts_upper(F.col("v")), starts_lower(F.col("v"))).collect()
    assert [tuple(r) for r in rows] == [(True, False, True), (False, True, False), (False, False, True), (False, False, False)]


def test_stopword_language(spark):
    rows = ["Der Hund und die Katze", "The cat and the dog", "Le chat et la souris", "El perro y la casa",
            "xyz qqq", "Das the"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, v string")
    got = [r.lang_pred for r in detect_language(df, "v").orderBy("i").collect()]
    assert got == ["de", "en", "fr", "es", None, "de"]


def test_sentences_and_tokens(spark):
    text = "  Das ist ein sehr kurzer Satz. Hier steht ein längerer Satz mit vielen Wörtern, der 2024 geschrieben wurde!\nNein"
    docs = spark.createDataFrame([(1, text)], "doc_id long, body string")
    s = sentences(docs, ["doc_id"], "body", keep_all=True).orderBy("sent_pos").collect()
    assert [r.sentence for r in s] == [
        "Das ist ein sehr kurzer Satz.",
        "Hier steht ein längerer Satz mit vielen Wörtern, der 2024 geschrieben wurde!",
        "Nein",
    ]
    assert [r.n_tokens for r in s] == [7, 14, 1]
    t = tokens(sentences(docs, ["doc_id"], "body"), ["doc_id"]).orderBy("tok_pos").collect()
    # only the second sentence has 10..100 tokens; token 0 is lower-cased
    assert [(r.tok_pos, r.token) for r in t] == [(1, "steht"), (3, "längerer"), (6, "vielen"), (7, "Wörtern"), (11, "geschrieben"), (12, "wurde")]


def test_parse_context_list(spark):
    from wordform.functions.text import parse_context_list

    got = _one(spark, ["['Ein Satz.', 'Noch einer.']", "['a']['b', 'c']"], parse_context_list)
    assert got == [["Ein Satz.", "Noch einer."], ["a", "b", "c"]]


def test_observe_rows(spark):
    from wordform.operators.metrics import observe_rows

    df, obs = observe_rows(spark.range(10).withColumn("corrupt", F.col("id") % 5 == 0), "seen")
    df.where("id > 3").count()
    assert obs.get == {"rows": 10, "corrupt": 2}


def test_title_word_matches_python(spark):
    from wordform.functions.predicates import title_word

    values = ["häus", "bauer-hof", "o'neil", "ÄRGER", "mixed CASE words"]
    assert _one(spark, values, title_word) == [v.title() for v in values]


def test_model_hooks(spark):
    """User models plug in as Arrow-batched pandas UDFs."""
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    from wordform.operators.filters import lang_filter

    @pandas_udf("array<string>")
    def by_semicolon(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [x for x in t.split(";")])

    @pandas_udf("array<string>")
    def by_space(s: pd.Series) -> pd.Series:
        return s.map(lambda t: t.split())

    @pandas_udf("string")
    def always_de(s: pd.Series) -> pd.Series:
        return s.map(lambda t: "de" if "Satz" in t else "xx")

    docs = spark.createDataFrame([(1, "a b c d e f g h i j; k l")], "doc_id long, body string")
    s = sentences(docs, ["doc_id"], "body", keep_all=True, sentence_model=by_semicolon, token_model=by_space)
    assert [(r.sentence, r.n_tokens) for r in s.orderBy("sent_pos").collect()] == [("a b c d e f g h i j", 10), ("k l", 2)]
    df = spark.createDataFrame([("Ein Satz hier",), ("nothing",)], "body string")
    assert [r.body for r in lang_filter(df, "body", "de", scorer=always_de).collect()] == ["Ein Satz hier"]
