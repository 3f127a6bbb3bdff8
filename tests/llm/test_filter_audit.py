import itertools
import math
import random
import re

from pyspark.sql import functions as F

from wordform.llm.filter_audit import OP11_SQL, audit, audit_steps, count_cells, masked, op11_filter_audit, text_filters

DOCS = "doc_id long, text string, lang string, mask int, words int, part string, n int"
LABELS = "doc_id long, quality int, toxic int, part string"


def brute(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = {}
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(w) < 200:
            fails.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t):
            fails.add("C")
        if any(c in "#$%&*|" for c in t):
            fails.add("D")
        if i is not None and t in first and first[t] < i:
            fails.add("E")
        parts.setdefault(lang or "", []).append((fails, i in good, i in toxic))
    out = []
    for part, rows in parts.items():
        removed_by = dict.fromkeys("ABCDE", 0)
        mine = []
        for order in itertools.permutations("ABCDE"):
            for k, letter in enumerate(order):
                earlier = set(order[:k])
                here = [r for r in rows if letter in r[0] and not r[0] & earlier]
                kept = sum(not r[0] & set(order[: k + 1]) for r in rows)
                redundant = sum(letter in r[0] and bool(r[0] & earlier) for r in rows)
                removed_by[letter] += len(here)
                mine.append([part, "".join(order), k + 1, kept, len(here), redundant, sum(r[0] == {letter} for r in rows), sum(r[1] for r in here), sum(r[2] for r in here), letter])
        out += [(*m[:-1], removed_by[m[-1]]) for m in mine]
    return sorted(out)


def got(spark, docs, labels):
    d = spark.createDataFrame([(i, t, lang, 9, 9, "x", 9) for i, t, lang in docs], DOCS)
    marks = spark.createDataFrame([(i, q, t, "x") for i, q, t in labels], LABELS)
    filters = text_filters()
    out = audit(count_cells(masked(d, filters), marks, 1 << len(filters)), "ABCDE")
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(tuple(r) for r in out.select(*columns).collect())


def fixture():
    rng = random.Random(5)
    word = lambda: rng.choice(["Aa", "b", "C", "dé", "e$", "😀f", "g", "hh", "Ii"]) + str(rng.randrange(200))
    texts = [" ".join(word() for _ in range(rng.choice([0, 1, 150, 199, 200, 201, 400]))) for _ in range(30)]
    texts += [" ".join(["same"] * 300), "\t\n ", "A" * 3 + "b" * 97, "A" * 4 + "b" * 96, None, "", None, "lone |"]
    docs = [(i, t, rng.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    docs += [(100 + i, texts[i % 9], rng.choice(["en", "de"])) for i in range(40)]
    docs += [docs[0], docs[0], (None, texts[0], "en"), (None, texts[0], "en"), (None, "only here", "fr"), (0, texts[1], "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 140, 2)] + [(0, 1, 1), (0, 0, 0), (None, 1, 1)]
    return docs, labels


def test_against_brute_force(spark):
    docs, labels = fixture()
    assert got(spark, docs, labels) == brute(docs, labels)


def test_empty_tables(spark):
    assert got(spark, [], []) == []
    rows = got(spark, [(1, None, None)], [])
    assert len(rows) == 600 and {r[0] for r in rows} == {""}
    assert rows == brute([(1, None, None)], [])


def test_sql(spark, oracle):
    oracle(op11_filter_audit, OP11_SQL)


def test_a_prefix_is_computed_once_and_parts_have_no_limit(spark):
    cells = spark.range(40).select(
        F.col("id").cast("string").alias("part"),
        F.array(F.struct(F.lit(3).alias("mask"), F.col("id").alias("n"), F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))).alias("cells"),
    )
    limit = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(limit, "100")
    try:
        steps = audit_steps(cells, "ABCD")
        assert steps.count() == 40 * sum(math.perm(4, k) for k in range(5))
    finally:
        spark.conf.unset(limit)


def test_a_long_text(spark):
    text = "word " * 400_000 + "$"
    docs = [(1, text, "en"), (2, text, "en")]
    assert got(spark, docs, [(2, 1, 0)]) == brute(docs, [(2, 1, 0)])
