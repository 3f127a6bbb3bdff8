"""Benchmark decontamination: a prefix-filtered set join.

A benchmark item is cut into windows of 13 words. A window is the set of its
3-word shingles; a document holds a window only if it holds all of them, so
the necessary prefix of a window under the order "rarest shingle first" is its
one rarest shingle. The join therefore runs on that shingle alone, drops
candidates by position and length, and compares the words of what is left.

Steps (all over every document and every item):

1. items -> words -> windows and shingles (Spark rows);
2. one scan of the documents keeps, per text, the stretches made of benchmark
   shingles that are long enough for a window (length bound), cut into
   overlapping segments of bounded size;
3. shingle rarity is counted over those segments of all documents;
4. each window's rarest shingle is joined with the segments' shingles,
   positions are checked, then the words themselves are compared;
5. hits are united per document.

The scan needs the set of benchmark shingles in each task. It is broadcast up
to ``max_shingles`` (8 bytes each); a larger benchmark is cut into blocks of
that size by item and the documents are scanned once per block.

Null or empty texts have no words and are never contaminated. Repeated rows are
judged one by one; equal windows of several items count for each of them.
Items with a null id still mark words but are not counted as items. Empty
tables give empty results or no hits. Other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordform.llm.common import ALNUM, Words, map_arrow, shingle_hashes, text_buffer, text_ranges, written

WINDOW = 13
SHINGLE = 3
#: Words of a segment beyond the overlap of one window.
SEGMENT = 64
MAX_SHINGLES = 2_000_000
#: Hash buckets of items, of which blocks are made.
BUCKETS = 4096
MAX_PREFIX_ROWS = 1_000_000

_SEG = "array<struct<k:int,first:bigint,words:array<string>,sh:array<bigint>>>"


def item_shingles(items: DataFrame, item_id: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, k, words, sh): the words of each item that has any, and the
    hash of the k = min(shingle, words) words from each position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            w = Words(data, offsets, ALNUM)
            h = w.hashes()
            ks, words, sh = [], [], []
            for a, b in zip(w.ptr[:-1].tolist(), w.ptr[1:].tolist()):
                k = min(shingle, b - a)
                ks.append(k)
                words.append(w.words(a, b))
                sh.append(shingle_hashes(h[a:b], k).view(np.int64) if k else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ks, pa.int32()), pa.array(words, pa.list_(pa.string())), pa.array(sh, pa.list_(pa.int64()))],
                names=["item_id", "k", "words", "sh"],
            )

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    return map_arrow(rows, run, f"item_id {kind}, k int, words array<string>, sh array<bigint>").where("k > 0")


def item_windows(shingled: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, k, win, win_words, win_sh): one row per window of an item."""
    n = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    return (
        shingled.select("item_id", "k", "words", "sh", F.explode(starts).alias("i"))
        .select(
            "item_id",
            "k",
            F.expr(f"slice(words, i + 1, least({window}, size(words)))").alias("win_words"),
            F.expr(f"slice(sh, i + 1, least({window}, size(words)) - k + 1)").alias("win_sh"),
        )
        .withColumn("win", F.array_join("win_words", " "))
    )


def _bucket() -> Column:
    return F.pmod(F.xxhash64("words"), F.lit(BUCKETS))


def item_blocks(shingled: DataFrame, max_shingles: int) -> list[tuple[int, int]]:
    """Ranges of hash buckets of items that hold at most ``max_shingles``
    distinct shingles each (or are one bucket); one range if all items do."""
    each = shingled.select("k", F.explode("sh").alias("sh"), _bucket().alias("bucket"))
    if each.select("k", "sh").distinct().count() <= max_shingles:
        return [(0, BUCKETS)]
    counts = {r["bucket"]: r["n"] for r in each.distinct().groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    blocks, first, held = [], 0, 0
    for bucket in range(BUCKETS):
        n = counts.get(bucket, 0)
        if held and held + n > max_shingles:
            blocks.append((first, bucket))
            first, held = bucket, 0
        held += n
    return [*blocks, (first, BUCKETS)]


def _segments(docs: DataFrame, known: dict[int, np.ndarray], least: dict[int, int], window: int) -> DataFrame:
    """(row_key, doc_id, n_words, segs): per document, the segments made of
    shingles in ``known`` (by k) of at least ``least[k]`` words. Rows without a
    ``row_key`` get one; it holds once the result is written."""
    shared = docs.sparkSession.sparkContext.broadcast((known, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, shortest = shared.value
        filters = {}
        for k, values in sets.items():
            bits = np.zeros(1 << 22, dtype=bool)
            bits[(values & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
            filters[k] = bits
        key = TaskContext.get().partitionId() << 36
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            if keyed:
                keys = batch.column(2)
            else:
                keys = pa.array(np.arange(key, key + batch.num_rows), pa.int64())
                key += batch.num_rows
            for a, b in text_ranges(offsets):
                w = Words(data, offsets[a : b + 1], ALNUM)
                h = w.hashes()
                counts = np.diff(w.ptr)
                end_of = np.repeat(w.ptr[1:], counts)
                segs: list[list[dict]] = [[] for _ in range(b - a)]
                for k, values in sets.items():
                    s = shingle_hashes(h, k)
                    at = np.flatnonzero(filters[k][(s & np.uint64((1 << 22) - 1)).astype(np.int64)])
                    at = at[at + k <= end_of[at]]
                    found = np.searchsorted(values, s[at])
                    at = at[values[np.minimum(found, len(values) - 1)] == s[at]]
                    if not len(at):
                        continue
                    doc = np.searchsorted(w.ptr, at, side="right") - 1
                    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(doc) != 0)) + 1
                    for lo, hi in zip(np.r_[0, cut].tolist(), np.r_[cut, len(at)].tolist()):
                        first, stop, d = int(at[lo]), int(at[hi - 1]) + k, int(doc[lo])
                        if stop - first < shortest[k]:
                            continue
                        for p in range(first, max(stop - window, first) + 1, SEGMENT):
                            q = min(p + SEGMENT + window - 1, stop)
                            segs[d].append({"k": k, "first": p - int(w.ptr[d]), "words": w.words(p, q), "sh": s[p : q - k + 1].view(np.int64)})
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(a, b - a), batch.column(0).slice(a, b - a), pa.array(counts, pa.int64()), pa.array(segs, seg_type)],
                    names=["row_key", "doc_id", "n_words", "segs"],
                )

    seg_type = pa.list_(pa.struct([("k", pa.int32()), ("first", pa.int64()), ("words", pa.list_(pa.string())), ("sh", pa.list_(pa.int64()))]))
    keyed = "row_key" in docs.columns
    rows = docs.select("doc_id", "text", *["row_key"] * keyed)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"row_key bigint, doc_id {kind}, n_words bigint, segs {_SEG}")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    share: int = 20,
    max_shingles: int = MAX_SHINGLES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items (sorted
    ids as strings) and contaminated (``share * n_hit >= n_words``, with a hit)."""
    shingled = written(item_shingles(items, item_id, item_text, shingle), "items")
    windows = written(item_windows(shingled, window), "windows")
    least = {r["k"]: r["least"] for r in windows.groupBy("k").agg(F.min(F.size("win_words")).alias("least")).collect()}
    blocks = item_blocks(shingled, max_shingles)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    if len(blocks) > 1:  # every scan must name a row alike
        docs = written(docs.withColumn("row_key", F.monotonically_increasing_id()), "keyed")
    tables = []
    for first, stop in blocks:
        part = shingled if len(blocks) == 1 else shingled.where((_bucket() >= first) & (_bucket() < stop))
        values = part.select("k", F.explode("sh").alias("sh")).distinct().toPandas()
        known = {int(k): np.sort(g["sh"].to_numpy(np.int64).view(np.uint64)) for k, g in values.groupby("k")}
        tables.append(written(_segments(docs, known, least, window), "segments"))
    scanned = tables[0]
    segs = scanned.select("row_key", F.explode("segs").alias("s"))
    for more in tables[1:]:
        segs = segs.unionByName(more.select("row_key", F.explode("segs").alias("s")))
    segs = segs.select("row_key", "s.k", "s.first", "s.words", "s.sh")

    # rarity of each shingle in what the documents kept; a window with a shingle that none kept cannot occur
    rarity = segs.select("k", F.explode("sh").alias("sh")).groupBy("k", "sh").agg(F.count("*").alias("n"))
    distinct = windows.dropDuplicates(["win"]).select("win", "k", "win_words", "win_sh")
    prefix = written(
        distinct.select("win", "k", "win_words", F.posexplode("win_sh").alias("offset", "sh"))
        .join(rarity, ["k", "sh"], "left")
        .groupBy("win")
        .agg(
            F.first("k").alias("k"),
            F.first("win_words").alias("win_words"),
            F.min_by(F.struct("sh", "offset"), F.struct("n", "sh", "offset")).alias("rare"),
            F.count_if(F.col("n").isNull()).alias("missing"),
        )
        .where("missing = 0")
        .select("win", "k", "win_words", "rare.sh", "rare.offset"),
        "prefix",
    )
    if prefix.count() <= MAX_PREFIX_ROWS:
        prefix = F.broadcast(prefix)
    hits = (
        segs.select("row_key", "k", "first", "words", F.posexplode("sh").alias("pos", "sh"))
        .join(prefix, ["k", "sh"])
        .withColumn("at", F.col("pos") - F.col("offset"))
        .withColumn("m", F.size("win_words"))
        .where("at >= 0 and at + m <= size(words) and slice(words, at + 1, m) = win_words")
        .select("row_key", "win", (F.col("first") + F.col("at")).alias("start"), "m")
        .distinct()
    )
    hits = written(hits, "hits")
    covered = (
        hits.groupBy("row_key")
        .agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("m")).alias("stop")))).alias("spans"))
        .select(
            "row_key",
            F.expr(
                "aggregate(spans, named_struct('n', 0L, 'to', 0L), (a, s) -> named_struct("
                "'n', a.n + greatest(s.stop - greatest(s.start, a.to), 0L), 'to', greatest(a.to, s.stop)), a -> a.n)"
            ).alias("n_hit"),
        )
    )
    named = (
        hits.select("row_key", "win")
        .distinct()
        .join(windows.where("item_id is not null").select("win", F.col("item_id").cast("string").alias("item")).distinct(), "win")
        .groupBy("row_key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    return (
        scanned.select("row_key", "doc_id", "n_words")
        .join(covered, "row_key", "left")
        .join(named, "row_key", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))
    )


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    from wordform.llm.common import table

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_ASCII = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"coalesce(regexp_extract_all(" + _ASCII + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

OP1_SQL = f"""
with items as (
  select item_id, {_WORDS.format('text')} as w from benchmark
), wins as (
  select distinct item_id, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') as win, least(13, len(w)) as m
  from (select item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) as i from items where len(w) > 0)
), docs as (
  select row_number() over () as rk, doc_id, {_WORDS.format('text')} as w from documents
), spots as (
  select rk, i, m, array_to_string(list_slice(w, i, i + m - 1), ' ') as win
  from (select rk, w, m, unnest(range(1, len(w) - m + 2)) as i
        from docs, (select distinct m from wins) where len(w) >= m)
), hits as (
  select rk, i, s.m, item_id from spots s join wins using (win)
), words as (
  select rk, count(distinct p) as n_hit
  from (select distinct rk, unnest(range(i, i + m)) as p from hits) group by rk
), named as (
  select rk, count(distinct item_id) as n_items,
         array_to_string(list_sort(list(distinct item_id::varchar)), ',') as ids
  from hits group by rk
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join words using (rk) left join named using (rk)
"""
