"""Approximate nearest neighbours by a hash-prefix forest.

Each of ``TREES`` trees hashes a vector to a string of ``BITS`` bits: the sides
of random hyperplanes, each put through the median of a bounded sample so that
its bit is balanced. A tree is the sorted array of these strings. A query's
string is looked up by its longest prefix; then all trees ascend together, one
bit at a time, and the rows under the shorter prefix join the candidates until
there are enough of them. Candidates are ranked by the exact distance.

The index is made of shards of at most ``SHARD`` rows (one table row each: ids,
vectors, sorted strings and their order), cut where the rows lie, so building it
moves nothing and no key can be hot. Every row is indexed. Queries are taken in
blocks of about ``BLOCK`` that are broadcast in turn to all shards; each shard
returns its best ``k`` and the best of all shards are ranked. A shard gathers at
least ``SHARE`` of its rows: vectors without any structure, as uniform ones in 64
dimensions, need that for a recall of 0.9; clustered data can do with less.

Vectors that are null, zero or hold null or non-finite components, and rows with
a null id, take no part. Vectors of another length than the query's are not
compared with it. Rows with the query's id are its own; a neighbour of several
equal rows counts once, at its smallest distance. Ties go to the smaller id. An
empty table gives no rows. Other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordform.llm.common import table, written

TREES = 48
BITS = 32
SHARD = 4096
BLOCK = 4096
SAMPLE = 2000
#: Share of a shard, and number of its rows, that are candidates at least.
SHARE = 0.65
LEAST = 64


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col("v")
    return (
        df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("v"))
        .where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
        .where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
        .where(F.exists(v, lambda x: x != 0))
    )


def _matrix(arr: pa.Array, rows: np.ndarray, width: int) -> np.ndarray:
    """The vectors of some rows of a list array, all of length ``width``, in double precision."""
    return np.array(arr.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(rows), width)


class Forest:
    """Hyperplanes per vector length: (TREES, BITS, length) and their thresholds."""

    def __init__(self, sample: list[np.ndarray], seed: int = 3):
        self.seed, self.planes = seed, {}
        for width in sorted({len(v) for v in sample}):
            x = np.stack([v for v in sample if len(v) == width])
            planes = self._normals(width)
            self.planes[width] = planes, np.median(x @ planes.reshape(-1, width).T, axis=0).reshape(TREES, BITS)

    def _normals(self, width: int) -> np.ndarray:
        return np.random.default_rng([self.seed, width]).normal(size=(TREES, BITS, width))

    def strings(self, x: np.ndarray) -> np.ndarray:
        """(TREES, rows) hash strings as numbers, the first bit the highest."""
        width = x.shape[1]
        if width not in self.planes:
            self.planes[width] = self._normals(width), np.zeros((TREES, BITS))
        planes, thresholds = self.planes[width]
        out = np.zeros((TREES, len(x)), np.uint64)
        for t in range(TREES):
            sides = (x @ planes[t].T > thresholds[t]).astype(np.uint64)
            out[t] = sides @ (np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64))
        return out


_INDEX = "width int, n int, ids binary, vectors binary, strings binary, places binary"


def build(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, Forest]:
    """The written index over every usable row, and its forest."""
    rows = usable(df, vec_id, vector)
    n = rows.count()
    unit = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40))
    sample = rows.where(unit < int((1 << 40) * min(1.0, SAMPLE / max(n, 1)))).orderBy("vec_id").limit(2 * SAMPLE).collect()
    forest = Forest([np.array(r["v"], np.float64) for r in sample])
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def shard(ids: np.ndarray, x: np.ndarray) -> tuple:
        strings = shared.value.strings(x)
        places = np.argsort(strings, axis=1, kind="stable")
        sorted_strings = np.take_along_axis(strings, places, 1).astype(np.uint32)
        return x.shape[1], len(ids), ids.tobytes(), x.tobytes(), sorted_strings.tobytes(), places.astype(np.int32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        names = ["width", "n", "ids", "vectors", "strings", "places"]
        made = lambda s: pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(s, kinds)], names=names)
        kept: dict[int, list] = {}  # per vector length: pieces of (ids, vectors) not yet in a shard
        for batch in batches:
            ids, widths = batch.column(0).to_numpy(), batch.column(1).value_lengths().to_numpy()
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                pieces = kept.setdefault(width, [])
                pieces.append((ids[at], _matrix(batch.column(1), at, width)))
                while sum(len(i) for i, _ in pieces) >= SHARD:
                    i, x = (np.concatenate(c) for c in zip(*pieces))
                    yield made(shard(i[:SHARD], x[:SHARD]))
                    pieces[:] = [(i[SHARD:], x[SHARD:])]
        for pieces in kept.values():
            i, x = (np.concatenate(c) for c in zip(*pieces))
            if len(i):
                yield made(shard(i, x))

    return written(rows.mapInArrow(run, _INDEX), "forest"), forest


def gather(strings: np.ndarray, places: np.ndarray, queries: np.ndarray, need: int) -> Iterator[np.ndarray]:
    """For each query (strings of all trees in a column) the rows that the
    synchronous ascent meets until there are ``need`` different ones."""
    n, q = strings.shape[1], queries.shape[1]
    found: list[np.ndarray | None] = [None] * q
    todo = np.arange(q)
    for level in range(BITS, -1, -1):
        if not len(todo):
            break
        below = np.uint64((1 << (BITS - level)) - 1)
        low, high = np.empty((TREES, len(todo)), np.int64), np.empty((TREES, len(todo)), np.int64)
        for t in range(TREES):
            prefix = queries[t, todo] & ~below
            low[t] = np.searchsorted(strings[t], prefix.astype(np.uint32), side="left")
            high[t] = np.searchsorted(strings[t], (prefix | below).astype(np.uint32), side="right")
        total = (high - low).sum(0)
        left = []
        for j, i in enumerate(todo.tolist()):
            if total[j] >= need or level == 0:
                met = np.zeros(n, dtype=bool)
                met[np.concatenate([places[t, low[t, j] : high[t, j]] for t in range(TREES)])] = True
                rows = np.flatnonzero(met)
                if len(rows) >= need or level == 0:
                    found[i] = rows
                    continue
            left.append(i)
        todo = np.array(left, np.int64)
    yield from found


def search(index: DataFrame, forest: Forest, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each usable row of ``queries``."""
    wanted = written(usable(queries, vec_id, vector).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    n = wanted.count()
    blocks = max(1, -(-n // BLOCK))
    parts = []
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).orderBy("vec_id").collect()
        by_width: dict[int, tuple] = {}
        for width in sorted({len(r["v"]) for r in rows}):
            mine = [r for r in rows if len(r["v"]) == width]
            x = np.array([r["v"] for r in mine], np.float64)
            by_width[width] = np.array([r["vec_id"] for r in mine]), x, forest.strings(x)
        shared = index.sparkSession.sparkContext.broadcast(by_width)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for width, size, ids, vectors, strings, places in zip(*(c.to_pylist() for c in batch.columns)):
                    if width not in shared.value:
                        continue
                    ids = np.frombuffer(ids, np.int64)
                    x = np.frombuffer(vectors, np.float64).reshape(size, width)
                    strings = np.frombuffer(strings, np.uint32).reshape(TREES, size)
                    places = np.frombuffer(places, np.int32).reshape(TREES, size)
                    keys, points, hashed = shared.value[width]
                    need = min(size, max(int(np.ceil(share * size)), LEAST, k + 1))
                    out: tuple[list, list, list] = ([], [], [])
                    for key, point, rows in zip(keys.tolist(), points, gather(strings, places, hashed, need)):
                        rows = rows[ids[rows] != key]
                        d = np.sqrt(((x[rows] - point) ** 2).sum(1))
                        best = np.lexsort((ids[rows], d))
                        _, first = np.unique(ids[rows][best], return_index=True)
                        best = best[np.sort(first)[:k]]
                        out[0].append(np.full(len(best), key))
                        out[1].append(ids[rows][best])
                        out[2].append(d[best])
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["query_id", "vec_id", "score"])

        parts.append(written(index.mapInArrow(run, "query_id bigint, vec_id bigint, score double"), "nearest"))
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    once = every.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")) if n else every
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_nearest(spark, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth embedding."""
    rows = table(spark, sf_dir, "embeddings")
    index, forest = build(rows)
    return search(index, forest, rows.where("vec_id % 100 = 0"))
