"""The rule tokeniser against a plain loop that peels mark by mark, and its rules one by one."""

import io
import random
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from wordform.operators import tokenizer as tk
from wordform.operators.segment import sentences
from wordform.operators.tokenizer import RuleTokenizer


def tokenized(spark, tok, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["x"] for r in rows.select("i", tok.tokenize(F.col("t")).alias("x")).orderBy("i").collect()]


def plain(text, table):
    out, words = [], text.split()
    for i, w in enumerate(words):
        left, right = "", ""
        while w not in table and not re.fullmatch(r"[^\W\d_]\.", w):
            if re.fullmatch(r"[0-9]+\.", w) and (right or i < len(words) - 1):
                break
            if w and w[0] in tk.OPENING:
                left, w = left + w[0], w[1:]
            elif w and w[-1] in tk.CLOSING:
                w, right = w[:-1], w[-1] + right
            else:
                break
        if w in table:
            mid = list(table[w])
        elif w.endswith(".") or re.search(tk.NUMBER, w) or re.search(tk.ADDRESS, w):
            mid = [w]
        else:
            cut = re.sub(f"({tk.INNER})", "\x1f\\1\x1f", w)
            cut = re.sub(r"([a-zäöüß])\.([A-ZÄÖÜ])", "\\1\x1f.\x1f\\2", cut)
            mid = [p for p in re.sub(r"([^\W\d_])(['’][sS])$", "\\1\x1f\\2", cut).split("\x1f") if p]
        out += re.findall(r"\.{2,}|.", left) + mid + re.findall(r"\.{2,}|.", right)
    return out


@pytest.mark.parametrize("text, tokens", [
    ("Geht's dir gut?", "Geht 's dir gut ?"),
    ("Das war Peter’s (altes) Auto.", "Das war Peter ’s ( altes ) Auto ."),
    ("Er kam (z.B. mit Dr. Meyer, usw.).", "Er kam ( z. B. mit Dr. Meyer , usw. ) ."),
    ("Am 3. Oktober um 12:30 zahlt er 3,50 € bis 20.", "Am 3. Oktober um 12:30 zahlt er 3,50 € bis 20 ."),
    ("J. Kruse und [„Ja/nein“] ... so:) :)", "J. Kruse und [ „ Ja / nein “ ] ... so : ) :)"),
    ("Haus.Dann z.B.: www.x.de/a?b=c, a@b.de! E-Mail--Nr. 7", "Haus . Dann z. B. : www.x.de/a?b=c , a@b.de ! E-Mail -- Nr . 7"),
    ("ja -- nein...", "ja -- nein ..."),
])
def test_rules(spark, text, tokens):
    assert tokenized(spark, RuleTokenizer(), text) == [tokens.split()]


def test_equal_to_plain_peeling(spark):
    rng = random.Random(6)
    table = tk.default_exceptions()
    pool = list("aBz3.,:()\"'’s!?…-/@€ ") + ["Dr.", "z.B.", ":)", "...", "12", "usw.", " ", " ", "Haus", "www."]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for text, got in zip(texts, tokenized(spark, RuleTokenizer(), *texts)):
        assert got == plain(text, table), repr(text)


def test_edges(spark):
    assert tokenized(spark, RuleTokenizer(), None, "", " \n ", "((", "...", "'s") == [None, [], [], ["(", "("], ["..."], ["'", "s"]]
    bare = RuleTokenizer({})
    assert tokenized(spark, bare, "z.B. Dr. A. :)") == [["z", ".", "B", ".", "Dr", ".", "A.", ":", ")"]]


def test_own_exceptions(spark):
    own = RuleTokenizer({"zum": ("zu", "m"), "Prof.Dr.": ("Prof.", "Dr.")})
    assert tokenized(spark, own, "(zum Prof.Dr.)") == [["(", "zu", "m", "Prof.", "Dr.", ")"]]
    learned = RuleTokenizer().with_abbreviations(["abt"])
    assert tokenized(spark, learned, "Abt. eins (abt.), z.B. so.") == [["Abt.", "eins", "(", "abt.", ")", ",", "z.", "B.", "so", "."]]
    for bad in ({"a b": ("a b",)}, {"ab": ("a", "c")}, {"": ()}):
        with pytest.raises(ValueError, match="make up the word"):
            tokenized(spark, RuleTokenizer(bad), "x")


def test_long_words_in_linear_time(spark):
    texts = ["(" * 300_000, "a" + "." * 300_000, "1" * 300_000 + ".", "a," * 100_000 + "a", "a!" + "?)" * 100_000]
    assert [len(t) for t in tokenized(spark, RuleTokenizer(), *texts)] == [300_000, 2, 2, 200_001, 200_002]


def test_neither_moves_rows_nor_needs_python(spark):
    out = io.StringIO()
    with redirect_stdout(out):
        spark.range(9).select(RuleTokenizer().tokenize(F.col("id").cast("string")).alias("s")).explain("formatted")
    assert not re.search(r"Exchange|Python|Join", out.getvalue())


def test_hook_of_sentences(spark):
    docs = spark.createDataFrame([(1, "Er (Hans) kam")], "id long, body string")
    got = sentences(docs, ["id"], "body", keep_all=True, token_model=RuleTokenizer().tokenize).collect()
    assert got[0]["tokens"] == ["Er", "(", "Hans", ")", "kam"] and got[0]["n_tokens"] == 5
