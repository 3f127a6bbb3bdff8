"""Toxicity by maximum-scoring segments.

Words get the log-odds between toxic and other labelled texts (each word once per
text), with a Dirichlet prior in proportion to their counts in the whole corpus; words whose log-odds are
not significant score 0. Each token's score is its word's less a drift, so
ordinary text scores below 0. A linear-time scan finds all maximal segments of a
text. The extreme-value theory of such scores gives each segment's expected
number of equals in clean text of that length, K n exp(-lambda S); lambda solves
sum p exp(lambda s) = 1 over the clean word distribution and K comes from the
clean labelled texts. The sum statistic of a text's best segments is turned into
a score by a logistic curve fitted to the same labelled texts.

Learned from at most about ``SAMPLE`` labelled texts per label, and from every
significant word of them (so their number is bounded by the sample's words); the
prior's counts cover the whole corpus. With only one
label, or no significant word, every score is 0. Null, empty and wordless texts
have no segment and the score of a text without any. Repeated rows get equal
scores. A null id is in no fold: ``held_out`` is null. Other columns are not
read."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordform.llm.common import ALNUM, Words, fold, map_arrow, map_text, table, text_buffer, text_ranges, written
from wordform.llm.labelled import labelled_sample

SAMPLE = 5000
#: Weight of the prior as a share of the words learned from, and its least count of a word.
PRIOR = 0.01
PRIOR_LEAST = 0.5
SIGNIFICANT = 3.0
DRIFT = 0.5
#: Best segments of a text that are summed.
SUMMED = 8


def word_counts(df: DataFrame, extra: str | None = None) -> DataFrame:
    """(word, n) over all texts of ``df``; with ``extra``, (word, kind, n) by
    that column, each word once per text, so that no single text makes a word
    significant. Counted per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            kinds = batch.column(1).to_pylist()
            counts: dict = {}
            for a, b in text_ranges(offsets):
                w = Words(data, offsets[a : b + 1], ALNUM)
                for d, (x, y) in enumerate(zip(w.ptr[:-1].tolist(), w.ptr[1:].tolist())):
                    counts.setdefault(kinds[a + d], Counter()).update(set(w.words(x, y)) if extra else w.words(x, y))
            for kind, c in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.string()), pa.array([kind] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())],
                    names=["word", "kind", "n"],
                )

    rows = df.select(F.coalesce(F.col("text").cast("string"), F.lit("")), F.col(extra) if extra else F.lit(0))
    by = ["word", "kind"] if extra else ["word"]
    return map_arrow(rows, run, "word string, kind int, n bigint").groupBy(*by).agg(F.sum("n").alias("n"))


def segments(scores: np.ndarray, at: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, token after the last, score)
    of tokens that score ``scores`` at the increasing places ``at`` and
    ``-DRIFT`` elsewhere. A stack keeps the candidates with the sums before and
    after them; every candidate is put on it and taken off it at most once."""
    stack: list[tuple[int, int, float, float, int]] = []  # first, stop, sum before, sum after, nearest lower candidate
    total, place = 0.0, 0
    for p, s in zip(at.tolist(), scores.tolist()):
        total -= DRIFT * (p - place)
        place = p + 1
        before, total = total, total + s
        if s <= 0:
            continue
        first, low = p, before
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= low:  # not a start that would help
                j = stack[j][4]
            if j < 0 or stack[j][3] >= total:
                break
            first, low = stack[j][0], stack[j][2]  # extends over that candidate: take it and what follows off
            del stack[j:]
            j = len(stack) - 1
        stack.append((first, p + 1, low, total, j))
    return [(first, stop, after - low) for first, stop, low, after, _ in stack]


class Model:
    """Scores of words (by hash, sorted), the extreme-value parameters and the logistic curve."""

    def __init__(self, hashes: np.ndarray, scores: np.ndarray):
        by = np.argsort(hashes)
        self.hashes, self.scores = hashes[by], scores[by]
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.rate, self.k, self.curve = 1.0, 1.0, (0.0, 0.0)

    def passages(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, list[tuple[int, int, float]], Words, int]]:
        """Per text: number of words, maximal segments, the words and the text's first one."""
        out = []
        for a, b in text_ranges(offsets):
            w = Words(data, offsets[a : b + 1], ALNUM)
            h = w.hashes()
            at = np.flatnonzero(self.bits[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            found = np.minimum(np.searchsorted(self.hashes, h[at]), max(len(self.hashes) - 1, 0))
            if len(self.hashes):
                hit = self.hashes[found] == h[at]
                at, found = at[hit], found[hit]
            scores = self.scores[found] - DRIFT if len(at) else np.zeros(0)
            cut = np.searchsorted(at, w.ptr)
            for d in range(b - a):
                x, y = cut[d], cut[d + 1]
                segs = segments(scores[x:y], at[x:y] - w.ptr[d]) if y > x else []
                out.append((int(w.ptr[d + 1] - w.ptr[d]), segs, w, int(w.ptr[d])))
        return out

    def expected(self, n: int, score: float) -> float:
        """Segments of at least this score that n words of clean text have."""
        return self.k * max(n, 1) * np.exp(-self.rate * score)

    def statistic(self, n: int, segs: list[tuple[int, int, float]]) -> float:
        """-log of the chance of so good a sum of best segments in clean text, the best number of them."""
        best, total = 0.0, 0.0
        top = sorted((s for _, _, s in segs), reverse=True)[:SUMMED]
        for r, s in enumerate(top, 1):
            total += self.rate * s - log(self.k * max(n, 1))
            if total > r:  # the tail formula holds beyond its mode
                value = total - (r - 1) * log(total) + lgamma(r + 1) + lgamma(r)
                best = max(best, value - log(r + 1))
        return min(best, 200.0)

    def score(self, value: float) -> float:
        a, b = self.curve
        return float(1 / (1 + np.exp(-np.clip(a + b * value, -40, 40))))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps with a little shrinkage; labels weigh alike."""
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    beta, m = np.zeros(2), np.stack([np.ones_like(x), x], 1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(m @ beta, -30, 30)))
        g = m.T @ (weight * (p - y)) + 1e-2 * beta
        hess = (m * (weight * p * (1 - p))[:, None]).T @ m + 1e-2 * np.eye(2)
        beta -= np.linalg.solve(hess, g)
    return float(beta[0]), float(beta[1])


def fit(sample: DataFrame, corpus: DataFrame) -> Model | None:
    """Learn from (doc_id, text, label) rows, with the word counts of ``corpus`` as prior."""
    sample = written(sample, "sample")
    counted = word_counts(sample, "label").groupBy("word").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == 1, F.col("n"))), F.lit(0)).alias("toxic"),
        F.coalesce(F.sum(F.when(F.col("kind") == 0, F.col("n"))), F.lit(0)).alias("clean"),
    )
    counted = written(counted, "sample-words")
    whole = written(word_counts(corpus), "corpus-words")
    size = whole.agg(F.sum("n")).first()[0] or 0
    totals = counted.agg(F.sum("toxic"), F.sum("clean")).first()
    if not size or not totals[0] or not totals[1]:
        return None
    n1, n0 = float(totals[0]), float(totals[1])
    weight = PRIOR * (n1 + n0)
    prior = F.lit(PRIOR_LEAST) + F.lit(weight) * F.coalesce("n", F.col("toxic") + F.col("clean")) / F.lit(float(size))
    y1, y0 = F.col("toxic") + F.col("prior"), F.col("clean") + F.col("prior")
    odds = F.log(y1 / (F.lit(n1 + weight + 1) - y1)) - F.log(y0 / (F.lit(n0 + weight + 1) - y0))
    words = (
        counted.join(whole, "word", "left")
        .withColumn("prior", prior)
        .select("word", odds.alias("odds"), F.sqrt(1 / y1 + 1 / y0).alias("sd"), (y0 / F.lit(n0 + weight + 1)).alias("p"))
        .withColumn("z", F.col("odds") / F.col("sd"))
        .where(F.abs("z") >= SIGNIFICANT)
        .orderBy(F.abs("z").desc(), "word")
        .collect()
    )
    if not any(r["odds"] > DRIFT for r in words):
        return None
    raw = "\n".join(r["word"] for r in words).encode()
    model = Model(Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM).hashes(), np.array([r["odds"] for r in words]))
    s = np.array([r["odds"] for r in words]) - DRIFT
    p = np.array([r["p"] for r in words])
    rest = max(0.0, 1 - p.sum())
    excess = lambda rate: float((p * np.exp(np.minimum(rate * s, 500))).sum() + rest * np.exp(-rate * DRIFT)) - 1
    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    model.rate = high
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.passages(*text_buffer(batch.column(0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([n for n, _, _, _ in found], pa.int64()), pa.array([[s for _, _, s in segs] for _, segs, _, _ in found], pa.list_(pa.float64()))],
                names=["label", "n", "scores"],
            )

    rows = sorted(map_arrow(sample.select("text", "label"), best, "label int, n bigint, scores array<double>").collect())
    clean = [r for r in rows if r["label"] == 0]
    least = DRIFT
    above = sum(s >= least for r in clean for s in r["scores"])
    model.k = max(above, 0.5) / (max(sum(r["n"] for r in clean), 1) * np.exp(-model.rate * least))
    x = np.array([model.statistic(r["n"], [(0, 0, s) for s in r["scores"]]) for r in rows])
    model.curve = _logistic(x, np.array([r["label"] for r in rows], np.float64))
    return model


def score(df: DataFrame, model: Model | None, keep: list[str], text: str = "text", significance: float = 0.01) -> DataFrame:
    """Per row, the columns ``keep``, ``score`` and ``passages``: the significant
    segments (words first:stop of the text, score, expected number in clean text)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        model = shared.value

        def run(t: pa.Array) -> dict[str, pa.Array]:
            if model is None:
                return {"score": pa.array(np.zeros(len(t))), "passages": pa.array([[]] * len(t), kind)}
            scores, passages = [], []
            for n, segs, _, _ in model.passages(*text_buffer(t)):
                scores.append(model.score(model.statistic(n, segs)))
                rated = [(a, b, s, float(model.expected(n, s))) for a, b, s in segs]
                passages.append([dict(zip(("first", "stop", "score", "expected"), r)) for r in rated if r[3] <= significance])
            return {"score": pa.array(scores, pa.float64()), "passages": pa.array(passages, kind)}

        return run

    return map_text(df, keep, make, "score double, passages array<struct<first:bigint,stop:bigint,score:double,expected:double>>", text)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from four folds of five."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(labelled_sample(docs, labels, "toxic", fold("doc_id", 5) != 0, SAMPLE), docs)
    scored = score(docs, model, ["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
