import hashlib
import random
import re

import pytest

from wordform.llm import decontam
from wordform.llm.decontam import OP1_SQL, decontaminate, op1_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            iw = words(item)
            m = min(13, len(iw))
            for i in range(len(iw) - m + 1 if m else 0):
                for p in range(len(w) - m + 1):
                    if w[p : p + m] == iw[i : i + m]:
                        hit.update(range(p, p + m))
                        if item_id is not None:
                            ids.add(str(item_id))
        out.append((doc_id, len(w), len(hit), len(ids), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(df):
    rows = df.select("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated").collect()
    return sorted([tuple(r) for r in rows], key=str)


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 9, "x") for i, t in docs], "doc_id long, text string, n_words int, items string")
    return d, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


def fixture(seed):
    rng = random.Random(seed)
    vocab = ["a", "b", "Cc", "dé", "e1", "f"]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", "."]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 13, 14, 30]))) for i in range(12)] + [(None, text(4)), (12, None), (13, ""), (3, text(6))]
    docs = [(i, text(rng.choice([0, 1, 2, 3, 12, 13, 40, 200]))) for i in range(40)]
    docs += [(i + 100, f"{text(8)} {t} {text(rng.randint(0, 300))}") for i, (_, t) in enumerate(items) if t]
    return docs + [(7, None), (None, items[5][1]), docs[3], docs[3]], items


@pytest.mark.parametrize("seed,shingle,bound", [(1, 3, 10**6), (2, 3, 20), (3, 2, 10**6)])
def test_against_brute_force(spark, seed, shingle, bound):
    docs, items = fixture(seed)
    d, b = tables(spark, docs, items)
    assert got(decontaminate(d, b, shingle=shingle, max_shingles=bound)) == brute(docs, items)


def test_long_runs_are_cut_without_loss(spark):
    rng = random.Random(4)
    item = " ".join(f"w{rng.randint(0, 40)}" for _ in range(400))
    docs = [(1, item), (2, "x " + " ".join(item.split()[50:300]) + " y"), (3, " ".join(item.split()[10:22]))]
    d, b = tables(spark, docs, [(1, item)])
    assert got(decontaminate(d, b)) == brute(docs, [(1, item)])


def test_empty_tables(spark):
    d, b = tables(spark, [(1, "a b c")], [(1, "a b")])
    assert decontaminate(d.limit(0), b).count() == 0
    assert got(decontaminate(d, b.limit(0))) == [(1, 3, 0, 0, [], False)]


def test_query_equals_sql(spark, oracle):
    oracle(op1_decontaminate, OP1_SQL)


def test_digest_of_no_items(spark):
    row = op1_decontaminate(spark, "/root/testdata/sf0.001").where("n_items = 0").first()
    assert row["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_blocks_are_bounded_by_shingles(spark, monkeypatch):
    sizes = []
    scan = decontam._segments
    monkeypatch.setattr(decontam, "_segments", lambda docs, known, *rest: sizes.append(sum(map(len, known.values()))) or scan(docs, known, *rest))
    items = [(i, " ".join(f"w{i}x{j}" for j in range(13))) for i in range(40)]  # a window and 11 shingles each
    docs = [(1, items[3][1]), (2, items[30][1] + " more")]
    d, b = tables(spark, docs, items)
    assert got(decontaminate(d, b, max_shingles=150)) == brute(docs, items)
    assert sum(sizes) == 440 and max(sizes) <= 150
