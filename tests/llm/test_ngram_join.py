import random

import numpy as np
import pytest

import wordform.llm.ngram_join as module
from wordform.llm.graph import components
from wordform.llm.ngram_join import LINKS_SQL, OP3_SQL, least_overlap, near_duplicates, ngram_links, op3_near_duplicates, signatures, similarity_join


def sets(text, k):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").split(" ")
    w = [x for part in w for x in part.split() if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(docs, k, percent):
    s = [sets(t, k) for _, t in docs]
    top = list(range(len(docs)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                top[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s[i]), least.get(find(i)) if s[i] else d) for i, (d, _) in enumerate(docs)), key=str)


def near_copies(seed, vocab, n=60):
    """Groups of texts that differ in a few words, over few words or many."""
    rng = random.Random(seed)
    docs = []
    for _ in range(n // 6):
        base = [f"w{rng.randrange(vocab)}" for _ in range(rng.choice([1, 2, 4, 10, 30, 60, 150]))]
        for _ in range(rng.randint(1, 10)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(vocab)}"
            docs.append((len(docs) * 3 % 101, " ".join(copy).replace("w1", "W1")))
    docs = list({d: t for d, t in docs}.items())
    return docs + [(200, None), (201, ""), (202, " \t"), docs[0], (None, docs[1][1]), (None, "lonely words here"), (203, docs[2][1].upper())]


@pytest.mark.parametrize("seed,vocab,k,percent", [(1, 5, 3, 90), (2, 2000, 3, 90), (3, 40, 5, 80), (4, 3, 2, 60)])
def test_against_brute_force(spark, seed, vocab, k, percent):
    docs = near_copies(seed, vocab)
    df = spark.createDataFrame([(d, t, 1, "fp") for d, t in docs], "doc_id long, text string, n int, fp string")
    rows = near_duplicates(df, k=k, percent=percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted([tuple(r) for r in rows], key=str) == brute(docs, k, percent)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for trial in range(3000):
        percent = int(rng.choice([60, 80, 90]))
        n = int(rng.integers(1, 90))
        pool = np.unique(rng.integers(0, 2**64 - 1, 2 * n + 20, dtype=np.uint64))
        x = np.sort(rng.choice(pool, n, replace=False))
        y = x.copy()
        drop = int(rng.integers(0, max(1, n // 4) + 1))
        y = np.unique(np.concatenate([np.delete(y, rng.choice(n, drop, replace=False)), rng.choice(pool, int(rng.integers(0, max(1, n // 4) + 1)))]))
        both = len(np.intersect1d(x, y))
        if not both or 100 * both < percent * (n + len(y) - both):
            continue
        frequent = [np.uint64(0), pool[len(pool) // 5], pool[len(pool) // 2], np.uint64(2**64 - 1)][trial % 4]
        assert len(np.intersect1d(signatures(x, frequent, percent), signatures(y, frequent, percent))), (trial, n, percent)


def test_least_overlap_is_exact():
    for percent in (60, 80, 90):
        for n in range(1, 300):
            m = least_overlap(n, percent)
            assert 100 * m >= percent * n > 100 * (m - 1)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2040)]
    edges += [(5, 5), (None, 3), (3, None)]
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            top[b] = a
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(top)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).count() == 0


def test_query_equals_sql(spark, oracle):
    oracle(op3_near_duplicates, OP3_SQL)


@pytest.mark.parametrize("seed,vocab,k,percent,block", [(1, 5, 3, 90, 2), (2, 2000, 3, 90, 128), (3, 40, 5, 80, 3)])
def test_all_links_within_components(spark, monkeypatch, seed, vocab, k, percent, block):
    monkeypatch.setattr(module, "BLOCK", block)
    docs = near_copies(seed, vocab)
    df = spark.createDataFrame([(d, t, 1, "fp") for d, t in docs], "doc_id long, text string, n int, fp string")
    rows, links = similarity_join(df, k=k, percent=percent)
    s = [sets(t, k) for _, t in docs]
    similar = lambda x, y: x and y and 100 * len(x & y) >= percent * len(x | y)
    want = [(d, len(x), sum(bool(similar(x, y)) for j, y in enumerate(s) if j != i)) for i, ((d, _), x) in enumerate(zip(docs, s))]
    got = [tuple(r) for r in rows.select("doc_id", "n_shingles", "n_links").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    classes = list({frozenset(x) for x in s if x})
    pairs = sorted((len(x & y), len(x | y)) for i, x in enumerate(classes) for y in classes[:i] if similar(x, y))
    assert pairs and sorted((r["both"], r["either"]) for r in links.collect()) == pairs


def test_links_equal_sql(spark, oracle):
    oracle(ngram_links, LINKS_SQL)


def test_sets_share_a_signature_over_several_bands():
    rng = np.random.default_rng(7)
    for n, m in [(51, 85), (30, 50), (100, 166), (7, 11)]:
        for _ in range(50):
            y = np.unique(rng.integers(0, 2**64 - 1, m, dtype=np.uint64))
            x = np.sort(rng.choice(y, n, replace=False))
            assert 100 * n >= 60 * m
            assert len(np.intersect1d(signatures(x, np.uint64(0), 60), signatures(y, np.uint64(0), 60))), (n, m)


def test_long_texts_around_the_limit(spark):
    """One group of long near copies, and texts that share a long passage only."""
    rng = random.Random(9)
    base = [f"v{rng.randrange(9000)}" for _ in range(1500)]
    docs = []
    for i in range(24):
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.choice([0, 20, 24, 25, 26, 27, 30, 60])):
            copy[at] = f"u{rng.randrange(9000)}"
        docs.append((i, " ".join(copy[: len(copy) - rng.choice([0, 0, 150])])))
    for i in range(24, 40):
        docs.append((i, " ".join(base[:900] + [f"t{rng.randrange(9000)}" for _ in range(600)])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs, 3, 90)
    assert len({r[2] for r in want}) > 17
    rows = near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted([tuple(r) for r in rows], key=str) == want


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(3)
    for bits in (8, module.WIDE_BITS):
        x = rng.integers(0, 2**64 - 1, 3000, dtype=np.uint64)
        y = np.concatenate([x[200:], rng.integers(0, 2**64 - 1, 300, dtype=np.uint64)])
        apart = sum(int(a).bit_count() for a in (module._parity(x, bits) ^ module._parity(y, bits)).view(np.uint64))
        assert apart <= 500 and (bits == 8 or apart > 300)


def test_lists_of_the_same_classes_are_one(spark):
    rows = [(s, s, c) for s, members in {9: [1, 2], 5: [1, 2], 7: [2, 1], 6: [1, 2, 3], 8: [1, 3], 4: [2, 3]}.items() for c in members]
    listed = spark.createDataFrame(rows, "sig long, pos int, cid long").repartition(5)
    got = sorted(tuple(r) for r in module.merged_lists(listed).select("sig", "weight", "pos", "cid").collect())
    assert got == [(4, 1, 4, 2), (4, 1, 4, 3), (5, 3, 5, 1), (5, 3, 5, 2), (6, 1, 6, 1), (6, 1, 6, 2), (6, 1, 6, 3), (8, 1, 8, 1), (8, 1, 8, 3)]


def test_rest_join_emits_a_shared_passage_once(spark, monkeypatch):
    """Texts that begin with one long passage and go on differently."""
    open_rows, real = [], module.written
    monkeypatch.setattr(module, "written", lambda df, name: open_rows.append(real(df, name).count()) or real(df, name) if name == "open" else real(df, name))
    shared = [f"s{i}" for i in range(300)]
    docs = [(d, " ".join(shared + [f"x{d}_{i}" for i in range(300 + d)])) for d in range(6)]
    df = spark.createDataFrame(docs + [(9, docs[0][1] + " end")], "doc_id long, text string")
    rows = near_duplicates(df, k=3, percent=50).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted([tuple(r) for r in rows], key=str) == brute(docs + [(9, docs[0][1] + " end")], 3, 50)
    assert open_rows and max(open_rows) <= 3 * len(docs)


def test_bitmaps_show_that_middle_sized_sets_differ(spark):
    """700 shingles of which 300 are shared: 256 bits would let them pass at 80 percent."""
    shared = [f"s{i}" for i in range(302)]
    docs = spark.createDataFrame([(d, " ".join(shared + [f"x{d}_{i}" for i in range(400)])) for d in range(8)], "doc_id long, text string")
    rank, frequent = module.order_of(module.bucket_counts(docs, 3))
    rows = module.sketches(docs, 3, 80, rank, frequent).select("doc_id", "n", *module.BITMAP)
    pairs = rows.alias("x").join(rows.alias("y"), module.F.col("x.doc_id") < module.F.col("y.doc_id"))
    assert pairs.count() == 28 and pairs.where(module._likely(80)).count() == 0


def test_rest_join_meets_a_pair_about_once(spark, monkeypatch):
    """Copies of one text with so many changes that few or none are similar: they share most of their lists."""
    rng, met, real = random.Random(11), [], module.meetings

    def meetings(lists, percent):
        out = real(lists, percent)
        met.extend(tuple(r) for r in out.select(module.F.least("x.cid", "y.cid"), module.F.greatest("x.cid", "y.cid")).collect())
        return out

    monkeypatch.setattr(module, "meetings", meetings)
    base = [f"b{i}" for i in range(400)]
    docs = []
    for d in range(30):
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.choice([2, 3, 5, 7, 8])):
            copy[at] = f"u{d}_{at}"
        docs.append((d, " ".join(copy)))
    docs += [(100 + d, " ".join(f"o{d % 40}_{i}" for i in range(60 + d // 40))) for d in range(400)]  # shingles as frequent as those of the base
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = near_duplicates(df, k=5, percent=80).select("doc_id", "n_shingles", "component_id").collect()
    want = brute(docs, 5, 80)
    assert sorted([tuple(r) for r in rows], key=str) == want and 1 < len({r[2] for r in want if r[0] < 30}) < 30
    assert len(met) <= 4 * len(set(met)), len(met) / len(set(met))
    assert set(met)


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_similar_sets_open_early(percent):
    """The first shingle of two similar sets, in any order of shingles, lies before the bound."""
    rng = np.random.default_rng(percent)
    for _ in range(2000):
        pool = rng.permutation(260)
        x, y = (np.sort(pool[: rng.integers(1, 200)]), np.sort(pool[rng.integers(0, 12) : rng.integers(13, 220)]))
        both = np.intersect1d(x, y)
        if not len(both) or 100 * len(both) < percent * (len(x) + len(y) - len(both)):
            continue
        overlap = -(-percent * (len(x) + len(y)) // (100 + percent))
        assert np.searchsorted(x, both[0]) <= len(x) - overlap and np.searchsorted(y, both[0]) <= len(y) - overlap


def test_lists_before_and_rare_ends(spark):
    """Rows that come too late for any member are left out; the rarest of merged lists is the unsigned least."""
    merged = module.merged_lists(spark.createDataFrame([(s, p, c) for p, s in enumerate([5, -7]) for c in (1, 2)], "sig long, pos int, cid long"))
    assert sorted(tuple(r) for r in merged.collect()) == [(5, 0, 1, 2), (5, 0, 2, 2)]
    rows = [(sig, pos, cid, cid, 100, True) for sig, pos in [(3, 0), (4, 5), (-9, 10), (-8, 11)] for cid in (1, 2)]
    lists = spark.createDataFrame(rows + [(6, 19, 1, 1, 100, True), (6, 2, 3, 3, 100, False)], "sig long, pos int, cid long, comp long, n long, plain boolean")
    got = {(r["sig"], r["cid"]): r["before"] for r in module.openings(lists, 90).collect()}
    assert got == {(3, 1): [], (3, 2): [], (4, 1): [3], (4, 2): [3], (6, 1): [3, 4], (6, 3): []}
