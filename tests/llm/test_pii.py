import hashlib
import itertools
import random
import re

import pytest

from wordform.llm.pii import KINDS, Field, base_spans, digest, find, fit, luhn, masked, op9_pii, rewritten, scan

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SF = "/root/testdata/sf0.001"


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_patterns_equal_the_plain_expressions():
    rng = random.Random(1)
    parts = ["a", "b.c", "@", "x@y.z", ".", "-", "+", "_", " ", "0", "1", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "4012-8888-8888-1881", "+1 (212) 555-0100", "é", "(", ")", "\n", "٣"]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert base_spans(text) == brute(text), text


def test_best_segmentation_is_the_maximum():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 7)
        field = Field()
        field.beside = rng.choice([0.0, -1.0, 0.5])
        cands = [(i, j, rng.randrange(4), rng.uniform(0.1, 3)) for i, j in itertools.combinations(range(n + 1), 2) if rng.random() < 0.5]
        best = 0.0
        for r in range(len(cands) + 1):
            if r > 4:
                break
            for pick in itertools.combinations(sorted(cands), r):
                if all(a[1] <= b[0] for a, b in zip(pick, pick[1:])):
                    best = max(best, sum(c[3] for c in pick) + field.beside * sum(a[1] == b[0] for a, b in zip(pick, pick[1:])))
        got = field.decode(n, cands)
        score = {(i, j, k): s for i, j, k, s in cands}
        total = sum(max(s for (i, j, k), s in score.items() if (i, j, k) == g) for g in got)
        total += field.beside * sum(a[1] == b[0] for a, b in zip(got, got[1:]))
        if r <= 5:
            assert total >= best - 1e-9


@pytest.fixture(scope="module")
def field(spark):
    return fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_finds_rewritten_spans_in_unseen_texts(spark, field):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id between 3000 and 6500").select("text").collect()]
    rng = random.Random(3)
    total = right = extra = 0
    for t in texts:
        base, spans = find(t, field)
        assert set(base) <= set(spans)
        extra += len(spans) > len(base)
        if len(base) == 1:
            new, span = rewritten(t, base[0], rng)
            total += 1
            right += any(s < span[2] and span[0] < e and k == span[1] for s, k, e in find(new, field)[1])
    assert total > 50 and right >= 0.85 * total
    assert extra <= 0.02 * len(texts)


def test_operator(spark, field):
    texts = [(1, "mail a.b@c.de now"), (2, None), (3, ""), (None, "ip 1.2.3.4."), (1, "mail a.b@c.de now"), (4, "é " * 60000 + "+1 212 555 0100")]
    df = spark.createDataFrame([(i, t, "z") for i, t in texts], "doc_id long, text string, spans string")
    rows = scan(df, field, ["doc_id"], ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "redacted"]).collect()
    want = []
    for i, t in texts:
        base = brute(t or "")
        want.append((i, *(sum(k == x for _, k, _ in base) for x in range(4)), hashlib.sha256(digest(base).encode()).hexdigest(), masked(t, base) if t else t))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert masked("a@b.cd x", [(0, 0, 6)]) == "<EMAIL> x"
    assert scan(df.limit(0), field, ["doc_id"], ["spans"]).count() == 0


def test_fit_on_nothing(spark):
    empty = fit(spark.createDataFrame([], "text string"))
    assert find("a@b.cd", empty) == ([(0, 0, 6)], [(0, 0, 6)])


def test_query_keeps_base_spans(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_pii(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(digest(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[1] == i for x in base) for i in range(4)]
        assert set(filter(None, digest(base).split(","))) <= set(r["spans"].split(","))


FORMS = ["anna.meyer at example.com", "anna at example.com", "anna {at} example.com", "anna [AT] example.com", "anna ( at ) example.com", "anna(AT)example.com",
         "anna {  at  } example.com", "anna [at] example [dot] com", "anna{dot}meyer{at}example{dot}com", "anna At example Dot com", "anna ( AT ) example ( DOT ) com"]


@pytest.mark.parametrize("form", FORMS)
def test_spelled_out_addresses_without_digits(form, field):
    text = f"Wer mehr wissen will, schreibt an {form} und wartet."
    start = text.index(form)
    base, spans = find(text, field)
    assert not base
    assert any(k == 0 and s < start + len(form) and e == start + len(form) for s, k, e in spans), spans
    assert "example" not in masked(text, spans)
    assert find("Sie kam at last, dot by dot, und ging.", field) == ([], [])


def test_a_table_of_numbers_is_walked_from_left_to_right():
    """One region as long as the text; its candidates are made one at a time."""
    import tracemalloc

    from wordform.llm import pii

    text = "12 34 " * 3000
    assert len(pii.regions(text)) == 1
    spans, cands = pii.candidates(text, 0, len(text))
    assert len(spans) == 6000 and sum(1 for _ in cands) > 40000
    field = pii.Field()
    tracemalloc.start()
    base, found = pii.find(text, field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert base == found == [] and peak < 200 * len(text)


def test_spans_that_touch_base_spans_are_left_out():
    import random

    from wordform.llm import pii

    class Every(pii.Field):
        """Takes each token that is a number."""

        def scores(self, cands):
            return [(i, j, 3, 1.0) for i, j, _ in cands if j - i == 1]

    rng = random.Random(4)
    for _ in range(300):
        text = " ".join(rng.choice(["1.2.3.4", "12345", "a@b.de", "word", "+49 170 1234567", "4111 1111 1111 1111", "77777"]) for _ in range(12))
        base, found = pii.find(text, Every())
        for s, k, e in set(found) - set(base):
            assert not any(s < y and x < e for x, _, y in base)
        left = set()
        for a, b in pii.regions(text):
            spans, cands = pii.candidates(text, a, b)
            left |= {(*spans[i], 0) for i, j, _ in cands if j - i == 1}
        left = {(s, 3, e) for s, e, _ in left if not any(s < y and x < e for x, _, y in base)}
        assert left == set(found) - set(base)


def test_long_regions_are_learned_from_in_stretches():
    from wordform.llm import pii

    base = [(10, 1, 20), (595, 2, 615), (1390, 0, 1420)]
    assert pii.stretches(0, 600, base) == [(0, 600)]
    assert pii.stretches(0, 2000, base) == [(0, 595), (1420, 2000)]
    assert pii.within(base, 0, 595) == base[:1] and pii.within(base, 10, 2000) == base
