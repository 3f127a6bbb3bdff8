"""Target-distribution importance resampling: draw the documents whose words look
most like the target's, with Gumbel noise so that the draw is a sample.

Weights are array-scored: hashed word runs are counted over all documents and
all target texts, each bucket's gain is one entry of an array, and a document's
weight is the sum of the entries of its features. Features are hashed by crc32,
computed for all words of a slice at once, one byte position at a time.

The cutoff is found by weighted median-of-medians. The keys of the documents
that may be drawn are written in sorted slices (at most ``SLICES``); a round takes
the median of what each slice has left, weighs it by how much that is, and pivots
on the weighted median: at least a quarter of all that is left falls on each side,
so every round discards that much for certain, until the cutoff key is exact.
Slices are sorted, so what a slice has left is a range of positions, and the
pivot's range of scores prunes the files. Only one median per slice and round
reaches the driver. The winners, and no other rows, are then sorted.

Bounds: a bucket array per task; texts are cut into slices of about 0.5 MB, and with
``n = 1`` a longer text too (at a word's end; a single longer word is hashed
alone). With longer runs of words a text is handled whole.

Defined cases: null text has no words, a document without words weighs 0; a null id
has a null score and isn't drawn or counted among the N; equal scores go to the smaller
id, rows that repeat an id to the fewer features, and rows equal in all that to
any of them; an empty table gives no rows; no target text counts as no features."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordform.llm.common import ALNUM, CHUNK_BYTES, Words, map_arrow, table, text_buffer, text_ranges, written
from wordform.llm.order import ROW_BITS, ROW_MASK, numbered

RUN_WORDS, BUCKETS, MIN_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Sorted slices of keys, at most.
SLICES = 1024
#: Keys left at which the rest of the search is a sort of so many on the driver.
FEW_KEYS = 4096

# -- features -----------------------------------------------------------------


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t.astype(np.uint32)


_CRC = _crc_table()
#: Longer words are hashed one at a time.
_SHORT = 64


def crc_feed(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Running crc32 registers (before the final inversion) after the bytes
    ``data[starts:ends]`` of each: all registers advance by one byte at a time,
    longest word first, so those at work are always the first ones."""
    size = np.minimum(ends - starts, _SHORT + 1).astype(np.uint8)
    order = np.argsort(_SHORT + 1 - size, kind="stable")
    s, at, size = state[order], starts[order], size[order]
    at_work = np.cumsum(np.bincount(size, minlength=_SHORT + 2)[::-1])[::-1]  # of at least that size
    n_long = int(at_work[_SHORT + 1])
    long_before = s[:n_long].copy()
    for p in range(_SHORT):
        m = int(at_work[p + 1])
        if not m:
            break
        head = s[:m]
        s[:m] = _CRC[(head ^ data[at[:m] + p]) & 0xFF] ^ (head >> 8)
    for i in range(n_long):
        j = order[i]
        raw = data[starts[j] : ends[j]].tobytes()
        s[i] = zlib.crc32(raw, int(long_before[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(state)
    out[order] = s
    return out


def run_buckets(words: Words, n: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1..n words: (bucket of each run, text that it belongs to)."""
    text = np.repeat(np.arange(len(words.ptr) - 1), np.diff(words.ptr))
    space = np.array([0x20], np.uint8)
    state = crc_feed(np.full(len(text), 0xFFFFFFFF, np.uint32), words.data, words.starts, words.ends)
    yield (state ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets), text
    for k in range(1, min(n, len(text))):
        whole = text[k:] == text[: len(text) - k]  # runs that end in their text
        first = np.flatnonzero(whole)
        state = crc_feed(state[: len(text) - k], space, np.zeros(len(text) - k, np.int64), np.ones(len(text) - k, np.int64))
        state = crc_feed(state, words.data, words.starts[k:], words.ends[k:])
        yield (state[first] ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets), text[first]


def _pieces(text: pa.Array, n: int) -> Iterator[tuple[int, int, Words]]:
    """(first row, rows, words) of slices of a text column; single words alone
    are features if ``n`` is 1, and then a long text is several slices."""
    data, offsets = text_buffer(text)
    for a, b in text_ranges(offsets, CHUNK_BYTES):
        lo, hi = int(offsets[a]), int(offsets[b])
        if n > 1 or b - a > 1 or hi - lo <= CHUNK_BYTES:
            yield a, b - a, Words(data, offsets[a : b + 1], ALNUM)
            continue
        while lo < hi:  # one long text
            cut = min(lo + CHUNK_BYTES, hi)
            while cut < hi and ALNUM[data[cut]]:
                word = ALNUM[data[cut : min(cut + CHUNK_BYTES, hi)]]
                cut += int(np.argmin(word)) if not word.all() else len(word)
            yield a, 1, Words(data, np.array([lo, cut], np.int64), ALNUM)
            lo = cut


def bucket_counts(df: DataFrame, n: int = RUN_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; a task sends one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, words in _pieces(batch.column(0), n):
                for found, _ in run_buckets(words, n, buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    texts = df.select(F.col("text").cast("string").alias("text"))
    return map_arrow(texts, run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of every bucket, smoothed by 1.
    ``source`` and ``target`` are counts; only ``buckets`` rows are there to collect."""
    counts = source.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    )
    s, t = np.zeros(buckets), np.zeros(buckets)
    for row in counts.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():
        s[row.bucket], t[row.bucket] = row.s, row.t
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighed(df: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", n: int = RUN_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, rows, words in _pieces(batch.column(1), n):
                here = slice(first, first + rows)
                n_words[here] += np.diff(words.ptr)
                for found, text in run_buckets(words, n, buckets):
                    n_features[here] += np.bincount(text, minlength=rows)
                    sums = np.concatenate([[0], np.cumsum(gain[found])])
                    ends = np.searchsorted(text, np.arange(rows + 1))
                    weight[here] += sums[ends[1:]] - sums[ends[:-1]]
            columns = [batch.column(0)] + [pa.array(x) for x in (n_words, n_features, weight)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln(u))), u from the first 32 bits of sha256(seed:doc_id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))) * F.lit(-1000.0))


# -- selection ----------------------------------------------------------------

#: What a key consists of, best first: greater scores, then smaller values of the rest.
KEY = ["score", "doc_id", "n_features", "row"]


def _before(key: dict, strict: bool = True) -> Column:
    """Rows whose key comes before (or is) the given one."""
    out = F.lit(not strict)
    for name in reversed(KEY):
        c, v = F.col(name), F.lit(key[name])
        out = ((c > v) if name == "score" else (c < v)) | ((c == v) & out)
    return out


def _rank(key: dict) -> tuple:
    return (-key["score"], *(key[c] for c in KEY[1:]))


def cutoff(rows: DataFrame, k: int) -> dict | None:
    """The k-th best key of ``rows`` (written; columns ``KEY``, keys unique), by
    weighted median-of-medians; None if there is none."""
    if k <= 0:
        return None
    spark = rows.sparkSession
    slices = rows.select(*KEY).coalesce(SLICES).sortWithinPartitions(F.col("score").desc(), *KEY[1:])
    keys = written(slices.withColumn("at", F.monotonically_increasing_id()), "keys")
    keys = keys.withColumn("slice", F.shiftright("at", ROW_BITS)).withColumn("pos", F.col("at").bitwiseAND(F.lit(ROW_MASK)))
    left = {r.slice: (0, r.n) for r in keys.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(n for _, n in left.values()) < k:
        return None
    low = high = None  # scores that the cutoff lies between

    def ranges() -> DataFrame:
        """Rows that are left."""
        bounds = spark.createDataFrame([(s, a, b) for s, (a, b) in left.items() if b > a], "slice long, lo long, hi long")
        here = keys if low is None else keys.where(F.col("score") >= low)
        here = here if high is None else here.where(F.col("score") <= high)
        return here.join(F.broadcast(bounds), "slice").where("pos >= lo and pos < hi")

    while sum(b - a for a, b in left.values()) > FEW_KEYS:
        medians = ranges().where("pos = lo + floor((hi - lo - 1) / 2)").select(*KEY, (F.col("hi") - F.col("lo")).alias("weight")).collect()
        medians = sorted((r.asDict() for r in medians), key=_rank)
        half, seen = sum(m["weight"] for m in medians) / 2, 0
        for pivot in medians:
            seen += pivot["weight"]
            if seen >= half:
                break
        ahead = {r.slice: r.n for r in ranges().where(_before(pivot, strict=False)).groupBy("slice").agg(F.count(F.lit(1)).alias("n")).collect()}
        n = sum(ahead.values())  # the pivot and all before it
        if n == k:
            return pivot
        if n > k:
            left = {s: (a, a + ahead.get(s, 0)) for s, (a, _) in left.items()}
            low = pivot["score"]
        else:
            left = {s: (a + ahead.get(s, 0), b) for s, (a, b) in left.items()}
            k, high = k - n, pivot["score"]
    rest = sorted((r.asDict() for r in ranges().select(*KEY).collect()), key=_rank)
    return rest[k - 1]


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    n: int = RUN_WORDS,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of
    ``docs``; ``rank`` is null unless the row is drawn."""
    gain = gains(bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets), buckets)
    rows = weighed(docs, gain, doc_id, n)
    rows = rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "weighed")
    may = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    n_may = rows.where(may).count()
    last = cutoff(rows.where(may), percent * n_may // 100)
    if last is None:
        return rows.drop("row").withColumn("rank", F.lit(None).cast("long"))
    drawn = may & _before(last, strict=False)
    others = rows.where(~F.coalesce(drawn, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    winners = numbered(rows.where(drawn), F.col("score").desc(), *KEY[1:])
    return winners.unionByName(others).drop("row")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# crc32 by half bytes; a word's half bytes are its hexadecimal digits, low one first
_HALVES = [int(_CRC[i << 4]) for i in range(16)]
OP12_SQL = rf"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r, TRUE AS doc,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
  UNION ALL
  SELECT NULL, NULL, FALSE,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark
), features AS (SELECT r, doc, unnest(w) AS f FROM words
), hashed AS (
  SELECT f, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(1, CAST(length(hex(f)) AS BIGINT) + 1),
             lambda i: CAST(strpos('0123456789ABCDEF', substr(hex(f), CASE WHEN i % 2 = 1 THEN i + 1 ELSE i - 1 END, 1)) - 1 AS BIGINT))),
           lambda c, d: xor(c >> 4, {_HALVES}[CAST((xor(c, d) & 15) + 1 AS BIGINT)]))) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM features)
), counts AS (
  SELECT bucket, count(*) FILTER (doc) AS s, count(*) FILTER (NOT doc) AS t FROM features JOIN hashed USING (f) GROUP BY bucket
), totals AS (SELECT CAST(sum(s) AS BIGINT) AS s, CAST(sum(t) AS BIGINT) AS t FROM counts
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(c.t AS DOUBLE) + 1) * (a.s + 10000) / ((CAST(c.s AS DOUBLE) + 1) * (a.t + 10000)))) AS BIGINT) AS gain
  FROM counts c, totals a
), weights AS (
  SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE doc GROUP BY r
), scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (r) WHERE doc
), ranked AS (
  SELECT *, n_features >= 20 AND score IS NOT NULL AS may,
         row_number() OVER (PARTITION BY n_features >= 20 AND score IS NOT NULL ORDER BY score DESC, doc_id, n_features) AS place,
         count(*) FILTER (n_features >= 20 AND score IS NOT NULL) OVER () AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""
