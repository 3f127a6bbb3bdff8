"""Language identification with a byte convolutional network.

The network reads windows of ``LENGTH`` bytes (A-Z lower-cased): byte
embeddings, filters of several widths, ReLU, the maximum over the window, a
softmax over languages. It is trained in numpy on a bounded sample of labelled
texts. For prediction the embeddings are folded into the filters, so that a
filter of width 2w is the sum of w look-ups of byte pairs; every window of every
text is scored and a text's score is the mean of its windows, by length.

Every labelled language is learned. Sample: per language ``SAMPLE_DOCS / languages``
different texts, or ``LEAST_DOCS`` if that is more (all, where it has fewer), those
with the smallest hashes (expected number; the threshold comes from the language's
count of different texts), of each at most ``SAMPLE_WINDOWS`` windows spread over
the whole text. A window that occurs in many copies is learned from once, so the
sample's size depends on the number of languages only. Windows of a text are
scored ``BATCH`` at a time, whatever its length.

A null text, an empty one and one without a letter are ``und`` with score 0; so
is every text if there is nothing to learn from. Repeated rows are judged
alike. A null id is in no fold: it is not learned from and ``held_out`` is
null. Other columns are not read."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordform.llm.common import _LOWER, fold, map_arrow, map_text, table, text_buffer

LENGTH = 256
WIDTHS = (2, 4, 6)
FILTERS = 16
EMBED = 8
PAD = max(WIDTHS) - 1
SAMPLE_DOCS = 6000
SAMPLE_WINDOWS = 4
LEAST_DOCS = 24
#: Steps of training, more of them from 100 languages on.
STEPS = 600
STEPS_PER_LANG = 6
#: Windows that are convolved at once.
BATCH = 256


def windows_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The windows at ``starts``, each cut at its text's end and filled with zeros."""
    at = starts[:, None] + np.arange(LENGTH + PAD)
    return np.where(at < ends[:, None], _LOWER[data[np.minimum(at, len(data) - 1)]], 0).astype(np.uint8)


class Net:
    """Embedding (256, EMBED), per width a filter (width * EMBED, FILTERS), bias, and the output layer."""

    def __init__(self, classes: int, rng: np.random.Generator):
        scale = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"e": rng.normal(0, 0.3, (256, EMBED)).astype(np.float32)}
        for w in WIDTHS:
            self.p[f"k{w}"] = scale(w * EMBED, FILTERS)
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.p["o"] = scale(len(WIDTHS) * FILTERS, classes)
        self.p["c"] = np.zeros(classes, np.float32)

    def loss_gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        p, n = self.p, len(x)
        emb = p["e"][x]
        pooled, kept = [], []
        for w in WIDTHS:
            view = np.lib.stride_tricks.sliding_window_view(emb, w, axis=1)[:, :LENGTH]  # n, LENGTH, EMBED, w
            patches = view.transpose(0, 1, 3, 2).reshape(n, LENGTH, w * EMBED)
            out = patches @ p[f"k{w}"]
            top = out.argmax(axis=1)  # n, FILTERS
            pooled.append(np.take_along_axis(out, top[:, None], 1)[:, 0] + p[f"b{w}"])
            kept.append((patches, top))
        hidden = np.concatenate(pooled, 1)
        active = np.maximum(hidden, 0)
        logits = active @ p["o"] + p["c"]
        prob = np.exp(logits - logits.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        loss = float(-np.log(prob[np.arange(n), y] + 1e-9).mean())
        delta = prob
        delta[np.arange(n), y] -= 1
        delta /= n
        g = {"o": active.T @ delta, "c": delta.sum(0), "e": np.zeros_like(p["e"])}
        back = (delta @ p["o"].T) * (hidden > 0)
        rows = np.arange(n)[:, None]
        for i, w in enumerate(WIDTHS):
            patches, top = kept[i]
            d = back[:, i * FILTERS : (i + 1) * FILTERS]
            best = patches[rows, top]  # n, FILTERS, w * EMBED
            g[f"b{w}"] = d.sum(0)
            g[f"k{w}"] = np.einsum("nf,nfe->ef", d, best)
            to = (d[:, :, None] * p[f"k{w}"].T[None]).reshape(-1, EMBED)
            where = x[rows[:, :, None], top[:, :, None] + np.arange(w)].reshape(-1)
            np.add.at(g["e"], where, to)
        return loss, g

    def tables(self) -> dict[str, np.ndarray]:
        """Filters over byte pairs, and the output layer."""
        out = {"o": self.p["o"], "c": self.p["c"]}
        for w in WIDTHS:
            k = self.p[f"k{w}"].reshape(w, EMBED, FILTERS)
            each = np.stack([self.p["e"] @ k[j] for j in range(w)])  # w, 256, FILTERS
            pairs = each[0::2, :, None] + each[1::2, None, :]  # w / 2, 256, 256, FILTERS
            pairs[0] += self.p[f"b{w}"]
            out[f"t{w}"] = np.ascontiguousarray(pairs.reshape(w // 2, 65536, FILTERS), np.float32)
        return out


def train(x: np.ndarray, y: np.ndarray, classes: int, seed: int = 7, steps: int = STEPS, batch: int = 64, rate: float = 0.01) -> Net:
    """Adam over random batches, each class as likely as any other."""
    rng = np.random.default_rng(seed)
    net = Net(classes, rng)
    of = [np.flatnonzero(y == c) for c in range(classes)]
    of = [o for o in of if len(o)]
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(a) for k, a in net.p.items()}
    for t in range(1, steps + 1):
        pick = np.array([rng.choice(of[c]) for c in rng.integers(0, len(of), batch)])
        _, g = net.loss_gradient(x[pick], y[pick])
        step = rate * min(1.0, 2 - 2 * t / steps)
        for k in net.p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            net.p[k] -= (step * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def score_windows(t: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Class probabilities of each window."""
    out = np.empty((len(x), len(t["c"])), np.float32)
    for a in range(0, len(x), BATCH):
        part = x[a : a + BATCH].astype(np.int32)
        pairs = (part[:, :-1] << 8) | part[:, 1:]
        pooled = []
        for w in WIDTHS:
            conv = np.take(t[f"t{w}"][0], pairs[:, :LENGTH], axis=0)
            for j in range(1, w // 2):
                conv += np.take(t[f"t{w}"][j], pairs[:, 2 * j : 2 * j + LENGTH], axis=0)
            pooled.append(conv.max(axis=1))
        logits = np.maximum(np.concatenate(pooled, 1), 0) @ t["o"] + t["c"]
        e = np.exp(logits - logits.max(1, keepdims=True))
        out[a : a + BATCH] = e / e.sum(1, keepdims=True)
    return out


def fit(docs: DataFrame, text: str, lang: str, seed: int = 7) -> tuple[list[str], dict[str, np.ndarray]] | None:
    """Languages and tables learned from the rows of ``docs`` with a language; None without any."""
    known = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null and text is not null")
    known = known.withColumn("h", F.pmod(F.xxhash64("text"), F.lit(1 << 40)))
    different = known.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row per language
    if not different:
        return None
    langs = sorted(r["lang"] for r in different)
    most = max(SAMPLE_DOCS / len(langs), LEAST_DOCS)
    bounds = [(r["lang"], int((1 << 40) * min(1.0, most / r["n"]))) for r in different]
    bounds = known.sparkSession.createDataFrame(bounds, "lang string, below bigint")
    sample = known.join(F.broadcast(bounds), "lang").where("h < below").select("text", "lang")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            names, rows = [], []
            for name, a, b in zip(batch.column(1).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                n = -(-(b - a) // LENGTH)
                for j in sorted({i * n // SAMPLE_WINDOWS for i in range(SAMPLE_WINDOWS)} if n else ()):
                    names.append(name)
                    rows.append(data[a + j * LENGTH : min(a + j * LENGTH + LENGTH + PAD, b)].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(rows, pa.binary())], names=["lang", "bytes"])

    windows = map_arrow(sample, cut, "lang string, bytes binary").distinct()
    rows = sorted(windows.collect(), key=lambda r: (bytes(r["bytes"]), r["lang"]))
    if not rows:
        return None
    x = np.zeros((len(rows), LENGTH + PAD), np.uint8)
    for i, r in enumerate(rows):
        x[i, : len(r["bytes"])] = _LOWER[np.frombuffer(bytes(r["bytes"]), np.uint8)]
    at = {name: i for i, name in enumerate(langs)}
    y = np.array([at[r["lang"]] for r in rows])
    return langs, train(x, y, len(langs), seed, steps=max(STEPS, STEPS_PER_LANG * len(langs))).tables()


_ASCII_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])


def identify(docs: DataFrame, model: tuple[list[str], dict[str, np.ndarray]] | None, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score`` of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        langs, tables = shared.value or ([], None)

        def run(texts: pa.Array) -> dict[str, pa.Array]:
            data, offsets = text_buffer(texts)
            begin, end = offsets[:-1], offsets[1:]
            letter = np.array([_ASCII_LETTER[data[a:b]].any() for a, b in zip(begin.tolist(), end.tolist())], dtype=bool)
            for i in np.flatnonzero(~letter & (end > begin)):
                letter[i] = any(c.isalpha() for c in texts[int(i)].as_py())
            if not langs:
                letter[:] = False
            n = np.where(letter, -(-(end - begin) // LENGTH), 0)
            first = np.concatenate([[0], np.cumsum(n)])
            doc = np.repeat(np.arange(len(n)), n)
            starts = begin[doc] + (np.arange(first[-1]) - first[doc]) * LENGTH
            names, scores = ["und"] * len(n), np.zeros(len(n))
            if len(doc):
                total = np.zeros((len(n), len(langs)))
                for a in range(0, len(doc), BATCH):
                    of, at = doc[a : a + BATCH], starts[a : a + BATCH]
                    size = np.minimum(end[of] - at, LENGTH)
                    np.add.at(total, of, score_windows(tables, windows_of(data, at, end[of])) * size[:, None])
                for i in np.flatnonzero(n):
                    best = int(total[i].argmax())
                    names[i] = langs[best]
                    scores[i] = min(1.0, total[i, best] / (end[i] - begin[i]))
            return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())}

        return run

    return map_text(docs, keep, make, "lang_pred string, score double", text)


def op10_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three folds of four."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold("doc_id", 4) != 2), "text", "lang")
    return identify(docs, model, ["doc_id"]).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
