"""Learned sentence ends: statistics against a plain count, rules, edge rows, plan, use as a hook."""

import io
import math
import random
import re
from collections import Counter
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from wordform.operators import sentence_model as sm
from wordform.operators.segment import sentences
from wordform.operators.sentence_model import SentenceModel, abbreviation_scores, follower_scores, type_counts


def german(n=300):
    rng = random.Random(1)
    names = "Meyer Schmidt Kruse Weber Becker Wagner Schulz Hoffmann".split()
    verbs = "kommt geht redet liest schreibt lacht schweigt".split()
    things = "Haus Garten Auto Buch Hund Tisch Zimmer Brief".split()
    out = []
    for _ in range(n):
        a, v, t, u = rng.choice(names), rng.choice(verbs), rng.choice(things), rng.choice(things)
        out.append(rng.choice([
            f"Heute {v} Dr. {a} ohne {t}. Dann {v} er mit {u}.",
            f"Er {v}, z. B. im {t}, ca. {rng.randint(2, 20)} Stunden. Dann {v} {a}.",
            f"Am {rng.randint(1, 30)}. Oktober {v} {a}. Dann {v} {a} ohne {u} usw. und so fort.",
            f"Am {rng.randint(1, 30)}. Mai {v} Frau Dr. {a}! Dann sah er {t}? Nun {v} sie mit {u}.",
            f"Das {t} und das {u} sind da. Dann {v} {a} mit {t}.",
        ]))
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(german())], "id long, body string")


@pytest.fixture(scope="module")
def learned(corpus):
    return SentenceModel.fit(corpus, "body")


def split(spark, model, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["s"] for r in rows.select("i", model.split(F.col("t")).alias("s")).orderBy("i").collect()]


def plain_counts(texts):
    n, dots = Counter(), Counter()
    for t in texts:
        for w in t.split():
            core = w.rstrip(sm.CLOSERS).lstrip(sm.OPENERS)
            bare = core.rstrip(sm.MARKS)
            kind = "#" if re.fullmatch(r"[0-9]+([.,:][0-9]+)*", bare) else bare.lower()
            if kind == "#" or re.search(r"[^\W\d_]", kind):
                n[kind] += 1
                dots[kind] += bool(re.fullmatch(r"\.[,;:]*", core[len(bare):]))
    return n, dots


def test_counts_and_scores_equal_a_plain_count(spark, corpus):
    texts = german() + ["(usw.), \"Nein.\" z.B. 3.5, 7. -- ... ,. ab", "", None]
    docs = spark.createDataFrame([(t,) for t in texts], "body string")
    got = {r["type"]: r for r in abbreviation_scores(type_counts(docs, "body")).collect()}
    n, dots = plain_counts(t for t in texts if t)
    assert {t: (r["n"], r["n_dot"]) for t, r in got.items()} == {t: (n[t], dots[t]) for t in n}
    p = (sum(dots.values()) + 1) / (sum(n.values()) + 2)
    for t, r in got.items():
        ratio = 2 * (dots[t] * math.log(0.99 / p) + (n[t] - dots[t]) * math.log(0.01 / (1 - p)))
        length = len(t.replace(".", ""))
        score = ratio * (t.count(".") + 1) * math.exp(-length) / length ** (n[t] - dots[t])
        assert abs(r["score"] - 1000 * score) <= 0.5 + 1e-6 * abs(1000 * score)
        assert r["abbreviation"] == (t != "#" and r["score"] >= 300)


def test_pairs_equal_a_plain_count(corpus):
    counts = type_counts(corpus, "body")
    got = {(r["left"], r["right"]): r for r in follower_scores(corpus, "body", counts, ["dr", "ca", "usw"]).collect()}
    pairs = Counter()
    for t in german():
        ws = [(w.rstrip(".,;:!?"), w) for w in t.split()]
        for (bare, w), (after, _) in zip(ws, ws[1:]):
            kind = "#" if bare.isdigit() else bare.lower()
            right = "#" if after.isdigit() else after.lower()
            if w.endswith(".") and (kind == "#" or len(kind) == 1 or kind in ("dr", "ca", "usw")):
                pairs[kind, right] += 1
            elif w[-1] in ".!?":
                pairs["", right] += 1
    assert {k: r["n_both"] for k, r in got.items()} == pairs
    lefts = Counter()
    for (left, _), k in pairs.items():
        lefts[left] += k
    n, _ = plain_counts(german())
    total = sum(n.values())

    def lnl(k, m, p):
        return (k * math.log(p) if k else 0) + ((m - k) * math.log(1 - p) if m > k else 0)

    for (left, right), r in got.items():
        k1, n1, k2, n2 = pairs[left, right], lefts[left], n[right] - pairs[left, right], total - lefts[left]
        p = n[right] / total
        ratio = 2 * (lnl(k1, n1, k1 / n1) + lnl(k2, n2, k2 / n2) - lnl(k1, n1, p) - lnl(k2, n2, p))
        assert abs(r["score"] - (1000 * ratio if k1 / n1 > p else -1000 * ratio)) < 0.51


def test_what_is_learned(learned):
    assert {"dr", "z", "b", "ca", "usw"} <= learned.abbreviations
    assert not learned.abbreviations & {"haus", "garten", "meyer", "oktober"}
    assert "dann" in learned.starters
    assert learned.ordinals == {"oktober", "mai"}


def test_abbreviations_and_ordinals_stay_inside(spark, learned):
    got = split(
        spark, learned,
        "Am 3. Oktober kam Dr. Meyer z. B. mit. Dann ging er. Es waren ca. 20. Dann war Ruhe.",
        "Er kam usw. Dann ging er.",
        "Er wohnt in Nr. 7. dort.",
        "Frau J. Kruse (s. o.) kam.",
    )
    assert got == [
        ["Am 3. Oktober kam Dr. Meyer z. B. mit.", "Dann ging er.", "Es waren ca. 20.", "Dann war Ruhe."],
        ["Er kam usw.", "Dann ging er."],
        ["Er wohnt in Nr.", "7. dort."],
        ["Frau J. Kruse (s. o.) kam."],
    ]


def test_marks_and_edges(spark):
    nothing = SentenceModel()
    assert split(spark, nothing, None, "", " \n\t", "a", "a.b.c", "\u3000aa. \u2028bb. ") == [None, [], [], ["a"], ["a.b.c"], ["aa.", "bb."]]
    assert split(spark, nothing, "Eins\nzwei  drei\n\nvier") == [["Eins", "zwei  drei", "vier"]]
    assert split(spark, nothing, 'Er rief: "Nein!" Gut?! (Ja.) So ... weiter... Ende… Aus 3.5 www.x.de. x') == [
        ['Er rief: "Nein!"', "Gut?!", "(Ja.)", "So ... weiter...", "Ende…", "Aus 3.5 www.x.de.", "x"]
    ]
    assert split(spark, nothing, "... . ? a . b") == [["... .", "?", "a .", "b"]]


def test_nothing_but_white_space_is_lost(spark, learned):
    rng = random.Random(4)
    pool = ["Dr.", "z.", "B.", "Haus", "3.", "Oktober", "dann", "Dann", " ", "\n", "\t", "!", "?", "...", "…", '"', "(", ")", ".", ",", " ", " ", "😀", "é"]
    texts = ["".join(rng.choice(pool) + rng.choice(["", " "]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for text, got in zip(texts, split(spark, learned, *texts)):
        assert re.sub(f"[{sm.SPACES}]", "", "".join(got)) == re.sub(f"[{sm.SPACES}]", "", text)
        assert all(s and s[0] not in sm.SPACES and s[-1] not in sm.SPACES for s in got)


def test_long_texts_in_linear_time(spark):
    texts = ["." * 400_000, "a" * 400_000, " " * 400_000 + "x", "aa. " * 60_000, "(" * 400_000, "ab " * 60_000]
    assert [len(s) for s in split(spark, SentenceModel(), *texts)] == [1, 1, 1, 60_000, 1, 1]


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], "body string")
    assert SentenceModel.fit(docs, "body") == SentenceModel()
    nulls = spark.createDataFrame([(None,), ("",), ("-- ...",)], "body string")
    assert SentenceModel.fit(nulls, "body") == SentenceModel()


def test_lists_beyond_the_bound_are_refused(corpus, monkeypatch):
    monkeypatch.setattr(sm, "MAX_ENTRIES", 2)
    with pytest.raises(ValueError, match="min_count"):
        SentenceModel.fit(corpus, "body")


def test_split_neither_moves_rows_nor_needs_python(spark, learned):
    out = io.StringIO()
    with redirect_stdout(out):
        spark.range(9).select(learned.split(F.col("id").cast("string")).alias("s")).explain("formatted")
    assert not re.search(r"Exchange|Python|Join", out.getvalue())


def test_hook_of_sentences(spark, learned):
    docs = spark.createDataFrame([(1, "  Am 3. Oktober kam Dr. Meyer. Dann ging er.  ")], "id long, body string")
    got = sentences(docs, ["id"], "body", keep_all=True, sentence_model=learned.split).orderBy("sent_pos").collect()
    assert [(r["sent_pos"], r["sentence"]) for r in got] == [(0, "Am 3. Oktober kam Dr. Meyer."), (1, "Dann ging er.")]
    assert got[1]["tokens"] == ["Dann", "ging", "er", "."]
