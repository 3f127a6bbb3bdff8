"""Quality classifier: histogram gradient-boosted trees over text statistics.

Each whole text gives ``FEATURES``: sizes, shares of character classes,
repetition of words, word pairs and lines. Features are cut into quantile bins; a
tree level sums gradients per node and bin (histograms) and splits each node
where the gain is largest. Trees are complete, so they flatten into arrays of
features, thresholds and leaves, and all rows descend all trees in step by
numpy indexing.

Learned from at most about ``SAMPLE`` labelled rows per label. With nothing to
learn from every score is 0.5. Null and empty texts have the features of the
empty text and are scored like any other. Repeated rows get equal scores. A null
id is in no fold: ``held_out`` is null. Other columns are not read."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordform.llm.common import NON_SPACE, Words, byte_table, fold, map_text, shingle_hashes, table, text_buffer
from wordform.llm.labelled import labelled_sample

SAMPLE = 6000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.15
L2 = 1.0

_CLASSES = {
    "letters": byte_table(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A),
    "upper": byte_table(lambda b: 0x41 <= b <= 0x5A),
    "digits": byte_table(lambda b: 0x30 <= b <= 0x39),
    "space": byte_table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D),
    "lines": byte_table(lambda b: b == 0x0A),
    "stops": byte_table(lambda b: b in b".!?"),
    "commas": byte_table(lambda b: b in b",;:"),
    "symbols": byte_table(lambda b: b in b"#$%&*+<=>@\\^_`{|}~/"),
    "quotes": byte_table(lambda b: b in b"\"'()[]-"),
    "high": byte_table(lambda b: b >= 0x80),
}
FEATURES = [
    "bytes", "words", *_CLASSES, "word_bytes", "word_bytes_sd", "longest_word", "distinct_words", "distinct_pairs",
    "top_word", "repeated_next", "words_per_stop", "words_per_line", "distinct_lines", "odd_ends",
]
_LINE = byte_table(lambda b: b != 0x0A)


def _per_text(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[ptr[1:]] - total[ptr[:-1]]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, FEATURES) of consecutive texts of a buffer."""
    data = data[offsets[0] : offsets[-1]]
    rel = offsets - offsets[0]
    n = np.diff(rel).astype(np.float64)
    w, lines = Words(data, rel, NON_SPACE), Words(data, rel, _LINE)
    size = (w.ends - w.starts).astype(np.float64)
    count = np.diff(w.ptr).astype(np.float64)
    some, full = np.maximum(count, 1), np.maximum(n, 1)
    share = {name: _per_text(member[data], rel) for name, member in _CLASSES.items()}
    mean = _per_text(size, w.ptr) / some
    h, g = w.hashes(), lines.hashes()
    pairs = shingle_hashes(h, 2)
    last = data[w.ends - 1] if len(w.ends) else data[:0]
    odd = (_CLASSES["symbols"] | byte_table(lambda b: b == 0x21))[last]
    cols = {"longest_word": [], "distinct_words": [], "distinct_pairs": [], "top_word": [], "repeated_next": [], "distinct_lines": []}
    for (a, b), (x, y) in zip(zip(w.ptr[:-1].tolist(), w.ptr[1:].tolist()), zip(lines.ptr[:-1].tolist(), lines.ptr[1:].tolist())):
        mine = h[a:b]
        _, times = np.unique(mine, return_counts=True)
        m = max(b - a, 1)
        cols["longest_word"].append(size[a:b].max() if b > a else 0)
        cols["distinct_words"].append(len(times) / m)
        cols["distinct_pairs"].append(len(np.unique(pairs[a : b - 1])) / max(b - a - 1, 1) if b - a > 1 else 1.0)
        cols["top_word"].append(times.max() / m if b > a else 0)
        cols["repeated_next"].append((mine[1:] == mine[:-1]).sum() / m)
        cols["distinct_lines"].append(len(np.unique(g[x:y])) / max(y - x, 1))
    by_name = {
        "bytes": np.log1p(n),
        "words": np.log1p(count),
        **{k: v / full for k, v in share.items()},
        "word_bytes": mean,
        "word_bytes_sd": np.sqrt(np.maximum(_per_text(size * size, w.ptr) / some - mean * mean, 0)),
        "words_per_stop": count / (share["stops"] + 1),
        "words_per_line": count / (share["lines"] + 1),
        "odd_ends": _per_text(odd, w.ptr) / some,
        **{k: np.array(v) for k, v in cols.items()},
    }
    return np.stack([by_name[f] for f in FEATURES], axis=1)


class Trees:
    """Complete trees: of node i the children are 2i+1 (at most the threshold) and 2i+2."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray, start: float):
        self.feature, self.threshold, self.leaf, self.start = feature, threshold, leaf, start

    def predict(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))[:, None]
        tree = np.arange(len(self.feature))[None]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[rows, self.feature[tree, at]] > self.threshold[tree, at])
        z = self.start + self.leaf[tree, at - (2**DEPTH - 1)].sum(1)
        return 1 / (1 + np.exp(-z))


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Newton boosting of the logistic loss on binned features."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    inner = 2**DEPTH - 1
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, 2**DEPTH)), 0.0)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    out.start = float(np.log(share / (1 - share)))
    z = np.full(n, out.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            base, nodes = 2**level - 1, 2**level
            best = np.zeros(nodes)
            split = np.full((nodes, 2), -1)
            for f in range(width):
                key = (at - base) * BINS + binned[:, f]
                gs = np.bincount(key, g, nodes * BINS).reshape(nodes, BINS)
                hs = np.bincount(key, h, nodes * BINS).reshape(nodes, BINS)
                gl, hl = gs.cumsum(1), hs.cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
                gain[:, len(cuts[f]) :] = 0
                b = gain.argmax(1)
                top = gain[np.arange(nodes), b]
                new = top > best + 1e-9
                best[new] = top[new]
                split[new] = np.stack([np.full(nodes, f), b], 1)[new]
            for node in np.flatnonzero(split[:, 0] >= 0):
                f, b = split[node]
                out.feature[t, base + node], out.threshold[t, base + node] = f, cuts[f][b]
            right = x[np.arange(n), out.feature[t, at]] > out.threshold[t, at]
            at = 2 * at + 1 + right
        leaf = at - inner
        out.leaf[t] = -RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + L2)
        z += out.leaf[t][leaf]
    return out


def text_features(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Per row, the columns ``keep`` and ``x``, the ``FEATURES`` of the whole text."""

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        return lambda t: {"x": pa.array(list(features(*text_buffer(t))), pa.list_(pa.float64()))}

    return map_text(df, keep, make, "x array<double>", text)


def fit(sample: DataFrame) -> Trees | None:
    """Trees from (text, label) rows; None without any."""
    rows = sorted(text_features(sample, ["doc_id", "label"]).collect())
    if not rows:
        return None
    return train(np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows], np.float64))


def score(df: DataFrame, trees: Trees | None, keep: list[str], text: str = "text") -> DataFrame:
    """Per row, the columns ``keep`` and ``score`` of the whole text."""
    shared = df.sparkSession.sparkContext.broadcast(trees)

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        trees = shared.value

        def run(t: pa.Array) -> dict[str, pa.Array]:
            return {"score": pa.array(np.full(len(t), 0.5) if trees is None else trees.predict(features(*text_buffer(t))), pa.float64())}

        return run

    return map_text(df, keep, make, "score double", text)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from two folds of three."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    trees = fit(labelled_sample(docs, labels, "quality", fold("doc_id", 3) != 1, SAMPLE))
    scored = score(docs, trees, ["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
