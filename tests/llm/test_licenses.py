import math
from collections import Counter

import numpy as np
import pytest

from wordform.llm.common import ALNUM, Words
from wordform.llm.licenses import HEADERS, TEMPLATES, bucket_frequencies, license_texts, op7_licenses, scan

SCHEMA = "id long, path string, text string, license string, row int"


def words(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    w = Words(raw, np.array([0, len(raw)]), ALNUM)
    return w.words(0, len(w.starts))


def brute(texts, least=0.5, window=32):
    """Best licence of each text by plain TF-IDF over every line."""
    n = len(texts)
    df = Counter(w for t in texts for w in set(words(t or "")))

    def vector(ws):
        return {w: c * (math.log((1 + n) / (1 + df[w])) + 1) for w, c in Counter(ws).items()}

    def cosine(a, b):
        dot = sum(v * b.get(w, 0) for w, v in a.items())
        return dot / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))

    templates = [(name, vector(words(t))) for name, t in sorted(TEMPLATES)]
    out = []
    for t in texts:
        best = (None, 0.0)
        for line in (t or "").split("\n"):
            ws = words(line)
            for x in range(0, max(len(ws) - window // 2, 1), window // 2):
                part = vector(ws[x : x + window])
                for name, v in templates if part else ():
                    s = cosine(part, v)
                    if s >= least and s > best[1] + 1e-12:
                        best = (name, s)
        out.append(best)
    return out


def test_own_licences_equal_plain_tf_idf(spark):
    texts = ["Released under the MIT License.", "so\nthis work is licensed under the gnu general public license, version 3 or later\nmore", "the license of the work",
             "some words " * 30 + "Licensed under the Apache License, Version 2.0 " + "and more words " * 30, "All rights reserved", "rights", "", None,
             "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "é all rights reserved É", "plain words only"]
    df = spark.createDataFrame([(i, f"d/{i}", t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r["id"]: (r["license"], r["score"]) for r in scan(df, keep=["id"]).where("origin <> 'inherited'").collect()}
    for i, (name, score) in enumerate(brute(texts)):
        if name is None:
            assert i not in got or got[i] == (None, 0.0)
        else:
            assert got[i][0] == name and got[i][1] == pytest.approx(score, abs=1e-9)


def test_inheritance_takes_the_nearest_ancestor(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [(1, "a/LICENSE", mit), (2, "a/x", "code"), (3, "a/b/y", "code"), (4, "a/b/c/LICENSE.txt", "title\nand\nmore\nlines\n\n" + gpl), (5, "a/b/c/d/z", "code"), (6, "top", "code"), (7, "other/f", "code"),
             (8, "a/b/late", "code\ncode\ncode\n\n" + gpl), (9, None, "code"), (10, None, mit), (2, "a/x", "code"), (11, "ab/q", "code"), (12, "a/b/w", None)]
    df = spark.createDataFrame([(i, p, t, "x", 1) for i, p, t in files], SCHEMA)
    got = sorted((r["id"], r["license"], r["origin"], r["from_path"]) for r in scan(df, keep=["id"]).collect())
    assert got == [
        (1, "MIT", "own", "a/LICENSE"), (2, "MIT", "inherited", "a/LICENSE"), (2, "MIT", "inherited", "a/LICENSE"), (3, "MIT", "inherited", "a/LICENSE"),
        (4, "GPL-3.0", "own", "a/b/c/LICENSE.txt"), (5, "GPL-3.0", "inherited", "a/b/c/LICENSE.txt"), (6, None, "none", None), (7, None, "none", None),
        (8, "GPL-3.0", "own", "a/b/late"), (9, None, "none", None), (10, "MIT", "own", None), (11, None, "none", None), (12, "MIT", "inherited", "a/LICENSE"),
    ]


def test_counts_and_empty(spark):
    df = spark.createDataFrame([("a b b",), ("b",), ("",)], "text string")
    counts, n = bucket_frequencies(df)
    assert n == 3 and sorted(counts[counts > 0].tolist()) == [1, 2]
    assert scan(spark.createDataFrame([], SCHEMA), keep=["id"]).count() == 0


def test_query_finds_every_notice(spark):
    sf = "/root/testdata/sf0.01"
    notices = {"CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "GPL-3.0": "GNU General Public License, version 3", "Apache-2.0": "Apache License, Version 2.0", "MIT": "the MIT License", "Proprietary": "All rights reserved."}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op7_licenses(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        mine = {k for k, v in notices.items() if v in (texts[r["doc_id"]] or "")}
        assert (r["license"] in mine) if mine else r["origin"] != "own"


def test_notices_in_the_middle_of_long_lines(spark):
    around = " ".join(f"plain{i}" for i in range(40))
    texts = [f"{around} {notice} {around}" for _, notice in TEMPLATES] + [f"{around} the rights of a public work under this license {around}", f"{around} all the {around} rights {around} reserved {around}"]
    df = spark.createDataFrame([(i, f"d{i}/x", t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r["id"]: (r["license"], r["score"]) for r in scan(df, keep=["id"], stretches=True).collect()}
    for i, (name, _) in enumerate(TEMPLATES):
        assert got[i][0] == name and got[i][1] > 0.9
    assert got[len(TEMPLATES)] == got[len(TEMPLATES) + 1] == (None, 0.0)


def test_query_finds_notices_in_running_text(spark, tmp_path):
    around = " ".join(f"plain{i}" for i in range(40))
    notices = ["Released under the MIT License", "All rights reserved", "Licensed under the Apache License, Version 2.0", "nothing of this kind"]
    docs = spark.createDataFrame([(i * 11 + 10, f"{around} {n} {around}", f"l{i}", f"s{i}") for i, n in enumerate(notices)], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [r["license"] for r in op7_licenses(spark, str(tmp_path)).orderBy("doc_id").collect()]
    assert got == ["MIT", "Proprietary", "Apache-2.0", None]


def test_headers_and_licence_files(spark, tmp_path):
    prose = "\n".join(" ".join(f"plain{i * j}" for i in range(8)) for j in range(60))
    wrap = lambda t, n: "\n".join(" * " + " ".join(t.split()[i : i + n]) for i in range(0, len(t.split()), n))
    texts = [(name, "/*\n * Copyright (c) Someone. All rights reserved.\n *\n" + wrap(t, 7) + "\n */\n" + prose) for name, t in HEADERS]
    texts += [(name, t) for name, t in license_texts()]
    texts += [(name, "All rights reserved by Someone\n\n" + " ".join(t.split())) for name, t in license_texts()]
    texts += [("Apache-2.0", "words before, licensed under the Apache\nLicense, Version 2.0, and after\n" + prose), (None, prose)]
    docs = spark.createDataFrame([(i * 11 + 10, t, f"l{i}", f"s{i}") for i, (_, t) in enumerate(texts)], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r["license"], r["score"]) for r in op7_licenses(spark, str(tmp_path)).orderBy("doc_id").collect()]
    assert [g[0] for g in got] == [name for name, _ in texts]
    assert all(score > 0.9 for _, score in got[:-2])
