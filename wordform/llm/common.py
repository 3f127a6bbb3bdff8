"""Helpers shared by the operators: written intermediate tables, label folds
and vectorised words and shingles over Arrow text buffers."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordform.session import cut_lineage, ensure_checkpoint_dir

#: Bytes of text that one vectorised step handles; a longer text is a step of its own.
CHUNK_BYTES = 1 << 19


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: lineage is
    cut, lost executors cost nothing that was written, rows are computed once.
    Inside a ``cut_scope`` the table is deleted at the scope's end."""
    return cut_lineage(df, f"llm-{name}")


def fold(id_col: str | Column, n: int) -> Column:
    """crc32(id as text) mod n; null for a null id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release() -> None:
    """Give freed memory back to the system: a Python worker lives on after its
    task, and what its allocators keep counts against the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` that releases memory at each task's end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(task, schema)


def text_ranges(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (or one row)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(arr.buffers()[1], np.int64, n + 1 + arr.offset)[arr.offset :]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def map_text(
    df: DataFrame,
    keep: list[str],
    make: Callable[[], Callable[[pa.Array], dict[str, pa.Array]]],
    schema: str,
    text_col: str = "text",
) -> DataFrame:
    """One output row per row: the columns ``keep`` and what ``make()``'s
    function returns for slices of the text column of at most ``CHUNK_BYTES``.
    ``make`` runs once per task, in the worker; the function's ``close``, if it
    has one, at the task's end."""
    names = [f.name for f in df.sparkSession.createDataFrame([], schema).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            text = batch.column(len(keep))
            _, offsets = text_buffer(text)
            for a, b in text_ranges(offsets):
                out = fn(text.slice(a, b - a))
                cols = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(cols + [out[c] for c in names], names=[*keep, *names])
        getattr(fn, "close", int)()

    kept = df.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("_text"))
    full = ", ".join([f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in keep] + [schema])
    return map_arrow(kept, run, full)


# -- words ------------------------------------------------------------------


def byte_table(member: Callable[[int], bool]) -> np.ndarray:
    return np.array([member(b) for b in range(256)], dtype=bool)


#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A or b >= 0x80)
#: Word bytes of ``[^\x20\x09-\x0D]+``.
NON_SPACE = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes that are hashed at once; a longer text takes several blocks.
HASH_BLOCK = CHUNK_BYTES + 4096
_powers: list[np.ndarray] = []


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    """``HASH_BLOCK`` powers of an odd base mod 2^64 and of its inverse."""
    if not _powers:
        for base in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
            p = np.full(HASH_BLOCK, base, np.uint64)
            p[0] = 1
            _powers.append(np.cumprod(p, dtype=np.uint64))
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of consecutive texts of one buffer.

    ``data`` (lower-cased bytes), ``starts``, ``ends`` (of each word in
    ``data``) and ``ptr`` (text i has the words ``ptr[i]:ptr[i+1]``)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word: np.ndarray):
        base = int(offsets[0])
        self.data = _LOWER[data[base : int(offsets[-1])]]
        rel = offsets - base
        inside = word[self.data]
        edge = np.zeros(len(inside) + 1, dtype=bool)
        edge[rel] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.ptr = np.searchsorted(self.starts, rel)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: its bytes as a polynomial, block by block."""
        power, inverse = _power_tables()
        out = np.zeros(len(self.starts), np.uint64)
        i = 0
        while i < len(out):
            base = int(self.starts[i])
            j = int(np.searchsorted(self.ends, base + HASH_BLOCK, side="right"))
            if j == i:  # a word longer than a block
                out[i] = self._long_word(base, int(self.ends[i]), power)
                i += 1
                continue
            block = self.data[base : int(self.ends[j - 1])]
            total = np.zeros(len(block) + 1, np.uint64)
            np.cumsum((block.astype(np.uint64) + np.uint64(1)) * power[: len(block)], out=total[1:])
            first = self.starts[i:j] - base
            out[i:j] = (total[self.ends[i:j] - base] - total[first]) * inverse[first]
            i = j
        return mix(out)

    def _long_word(self, start: int, end: int, power: np.ndarray) -> np.uint64:
        value = 0
        for at in range(start, end, HASH_BLOCK):
            piece = self.data[at : min(at + HASH_BLOCK, end)]
            part = int(((piece.astype(np.uint64) + np.uint64(1)) * power[: len(piece)]).sum(dtype=np.uint64))
            value += part * pow(int(_BASE), at - start, 1 << 64)
        return np.uint64(value % (1 << 64))

    def words(self, a: int, b: int) -> list[str]:
        raw = self.data.tobytes()
        return [raw[s:e].decode("utf-8", "replace") for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())]


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position of one word sequence; shingles
    that run over the end are left out."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = mix(out * _BASE + h[j : j + n])
    return out


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, such that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Keys of 32 bytes that ``without`` broadcasts at most.
MAX_BROADCAST_KEYS = 1_000_000


def without(df: DataFrame, keys: DataFrame, key: Column, name: str, keep: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``keys`` (or is, with ``keep``).
    The written, distinct keys are broadcast up to a checked count, else the
    rows are shuffled by key (a semi or anti join needs no salt: AQE splits it)."""
    own = unused(df, "_own")
    theirs = unused(df.withColumn(own, key), "_key")
    keys = written(keys.select(F.col(name).alias(theirs)).distinct(), "keys")
    if keys.count() <= MAX_BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return df.withColumn(own, key).join(keys, F.col(own) == F.col(theirs), "left_semi" if keep else "left_anti").drop(own)
