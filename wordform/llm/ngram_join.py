"""N-gram Jaccard join by prefixes of token combinations.

A text's set is that of its distinct k-word shingles. Texts with equal sets are
one class, and one member of each class stands for it from then on. Shingles are
ordered by how often their hash bucket occurs in the whole corpus, the rarest
first. If two sets are similar enough, at most ``unshared`` shingles of either
are not in the other; so a prefix of ``unshared + 1`` shingles shares one with
the other's prefix. Frequent shingles come last and make long posting lists.
They are therefore dealt into token classes, the prefix is extended until
``rare ones + sum over classes of (its shingles - 1)`` exceeds ``unshared``, and
within a class pairs of shingles are indexed instead of single ones: two
similar sets then share a rare shingle or a pair of one class.

Candidates come from equal signatures, without emitting all pairs of a list:

1. each list names one member, the one with the fewest rarer shingles before
   it, and each class is held against the member that most of its lists name, if
   these are at least half as many as a link needs; verified links give
   components;
2. lists that still hold several components pair members of different
   components only. This rest is complete: no link between components is lost.
   A pair is needed in the first list that both have only: there the shingles
   from their places on are as many as the least overlap, and the lists just
   before it are not the same ones.

Signatures that the same classes have are one list, which counts as many times: a
passage that several texts share gives a pair of them once, however long it is.

Candidates pass a length bound, a bound on the symmetric difference (parity
bitmaps of 512 bits; in the rest, where texts that share long passages meet in many
lists, of 2048 bits for sets from 1024 shingles on, whose difference 512 bits can't
show) and, in the rest, a bound on the number of signatures that they share, counted
once per pair, before their whole sets are compared.

``similarity_join`` gives all links: every link lies within a component, so the
classes of each are compared with each other, by size, bitmap and whole sets. They
are dealt into blocks of about ``BLOCK`` and each pair of blocks is one group, so
that a component of any size is many tasks; small ones share groups.

Sets up to 7 shingles index single shingles only. Without words or text a set is
empty, links with nothing and is its own component, as is any row without a
partner. Repeated rows and copies are one class. Rows with a null id take part
and get their component's smallest id, or null if it has none; rows with one id
and different texts are different documents. Other columns are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordform.llm.common import NON_SPACE, Words, map_arrow, mix, shingle_hashes, table, text_buffer, text_ranges, written
from wordform.llm.graph import components
from wordform.session import cut_scope

SHINGLE = 3
PERCENT = 90
#: Buckets of shingle counts: 2^18, counted over the whole corpus.
BITS = 18
_MASK = np.uint64((1 << BITS) - 1)
#: A shingle is frequent if its bucket holds this many times the mean.
FREQUENT = 4
#: Sets below 2^3 shingles have no frequent class.
SMALL_BAND = 3
MAX_BROADCAST_SIGNATURES = 2_000_000
#: Parity bitmaps have 2^9 bits; sets of so many shingles have a second one, of 2^11.
BITMAP_BITS = 9
BITMAP = [f"p{i}" for i in range(1 << (BITMAP_BITS - 6))]
WIDE_FROM, WIDE_BITS = 1024, 11
#: Lists of a class before one, in the rest, of which another class must have none.
BEFORE = 4
#: Classes of a component that are compared with as many others at once.
BLOCK = 128


def _doc_shingles(w: Words, h: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Shingle hashes of each text, with repetitions; of fewer words than k, all as one."""
    s = shingle_hashes(h, k)
    for a, b in zip(w.ptr[:-1].tolist(), w.ptr[1:].tolist()):
        yield s[a : b - k + 1] if b - a >= k else shingle_hashes(h[a:b], b - a) if b > a else s[:0]


def bucket_counts(docs: DataFrame, k: int) -> np.ndarray:
    """Shingles of each hash bucket over all rows of ``docs`` (text in ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            for a, b in text_ranges(offsets):
                w = Words(data, offsets[a : b + 1], NON_SPACE)
                all_of = np.concatenate([*_doc_shingles(w, w.hashes(), k), np.zeros(0, np.uint64)])
                counts += np.bincount((all_of & _MASK).astype(np.int64), minlength=1 << BITS)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(counts[full], pa.int64())], names=["bucket", "n"])

    rows = map_arrow(docs.select("text"), run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << BITS, np.int64)
    counts[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts


def order_of(counts: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """(rank of each bucket, smallest frequent token). A token is the shingle's
    hash with its bucket replaced by the bucket's rank, in front: a bijection
    whose numeric order is rarity."""
    by = np.argsort(counts, kind="stable")
    rank = np.empty(1 << BITS, np.uint64)
    rank[by] = np.arange(1 << BITS, dtype=np.uint64)
    full = counts[counts > 0]
    limit = FREQUENT * full.mean() if len(full) else 0
    return rank, np.uint64(int((counts <= limit).sum()) << (64 - BITS)) if (counts > limit).any() else np.uint64(2**64 - 1)


def tokens_of(shingles: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return np.unique((rank[(shingles & _MASK).astype(np.int64)] << np.uint64(64 - BITS)) | (shingles >> np.uint64(BITS)))


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any similar one, at least."""
    return -(-percent * n // 100)


def signatures(t: np.ndarray, frequent: np.uint64, percent: int) -> np.ndarray:
    """Signatures of a set of sorted tokens: its prefix's rare tokens, and pairs
    of frequent ones of one class. Two sets that are ``percent`` similar share
    one of them, see the module."""
    n = len(t)
    need = n - least_overlap(n, percent) + 1
    rare = int(np.searchsorted(t, frequent))
    if rare >= need:
        return t[:need]
    out = [t[:rare]]
    # the number of classes is fixed by bands of sizes: all that sizes of similar sets reach into, two from 71 percent on
    lo, hi = least_overlap(n, percent).bit_length() - 1, (100 * n // percent).bit_length() - 1
    for band in range(lo, hi + 1):
        if band < SMALL_BAND:
            out.append(t[:need])
            continue
        classes = np.uint64(1 << (band - SMALL_BAND))
        tail = t[rare:]
        cls = mix(tail) % classes
        first = np.ones(len(tail), dtype=bool)
        by = np.argsort(cls, kind="stable")
        first[by[1:]] = cls[by[1:]] != cls[by[:-1]]
        stop = int(np.searchsorted(np.cumsum(~first), need - rare)) + 1
        by = by[by < stop]
        cut = np.flatnonzero(np.diff(cls[by])) + 1
        for group in np.split(by, cut):
            if len(group) > 1:
                i, j = np.triu_indices(len(group), 1)
                x = tail[group]  # in token order, as the sort is stable
                out.append(mix(mix(x[i] + np.uint64(band)) ^ x[j]))
    return np.unique(np.concatenate(out))


def _parity(hashes: np.ndarray, bits: int) -> np.ndarray:
    """For each value of the first ``bits`` bits, whether an odd number of hashes has it: 64 to a word."""
    odd = np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


_SKETCH = f"digest binary, fp binary, n bigint, plain boolean, {', '.join(f'{p} bigint' for p in BITMAP)}, sigs array<bigint>, pos array<int>, wide array<bigint>"


def sketches(docs: DataFrame, k: int, percent: int, rank: np.ndarray, frequent: np.uint64) -> DataFrame:
    """Per row: id, digest of the text, fingerprint and size of its set, whether
    its signatures are single shingles only, the set's parity bitmap, its
    signatures and each one's place in the order."""
    shared = docs.sparkSession.sparkContext.broadcast((rank, frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, frequent = shared.value
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for a, b in text_ranges(offsets):
                w = Words(data, offsets[a : b + 1], NON_SPACE)
                raw, base = data[offsets[a] : offsets[b]].tobytes(), int(offsets[a])
                cols: list[list] = [[] for _ in range(7 + len(BITMAP))]
                for d, s in zip(range(a, b), _doc_shingles(w, w.hashes(), k)):
                    t = tokens_of(s, rank)
                    one = mix(t)
                    bits = _parity(one, BITMAP_BITS)
                    fp = np.array([one.sum(dtype=np.uint64), mix(one + np.uint64(1)).sum(dtype=np.uint64)])
                    sig = signatures(t, frequent, percent) if len(t) else t
                    cols[0].append(hashlib.md5(raw[offsets[d] - base : offsets[d + 1] - base]).digest())
                    cols[1].append(fp.tobytes())
                    cols[2].append(len(t))
                    cols[3].append(int(np.searchsorted(t, frequent)) > len(t) - least_overlap(len(t), percent))
                    for i, p in enumerate(bits):
                        cols[4 + i].append(p)
                    cols[-3].append(sig.view(np.int64))
                    cols[-2].append(np.searchsorted(t, sig).astype(np.int32))
                    cols[-1].append(_parity(one, WIDE_BITS) if len(t) >= WIDE_FROM else None)
                kinds = [pa.binary(), pa.binary(), pa.int64(), pa.bool_(), *[pa.int64()] * len(BITMAP), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(c, kind) for c, kind in zip(cols, kinds))],
                    names=["doc_id", "digest", "fp", "n", "plain", *BITMAP, "sigs", "pos", "wide"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, {_SKETCH}")


def verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` (a, da, b, db) whose sets are similar. ``texts``
    has (digest, text); only the texts that pairs need are moved."""
    need = written(pairs.select(F.col("da").alias("digest")).union(pairs.select(F.col("db").alias("digest"))).distinct(), "needed")
    if need.count() <= MAX_BROADCAST_SIGNATURES:
        need = F.broadcast(need)
    some = written(texts.join(need, "digest", "left_semi").dropDuplicates(["digest"]), "texts")
    with_texts = pairs.join(some.select(F.col("digest").alias("da"), F.col("text").alias("ta")), "da").join(
        some.select(F.col("digest").alias("db"), F.col("text").alias("tb")), "db"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for c in (2, 3):
                data, offsets = text_buffer(batch.column(c))
                mine = []
                for a, b in text_ranges(offsets):
                    w = Words(data, offsets[a : b + 1], NON_SPACE)
                    mine += [np.unique(s) for s in _doc_shingles(w, w.hashes(), k)]
                sets.append(mine)
            keep = []
            for x, y in zip(*sets):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(with_texts.select("a", "b", "ta", "tb"), run, "a bigint, b bigint")


def _likely(percent: int, wide: bool = False) -> Column:
    """Bounds on a candidate pair x, y of classes: sizes, and the symmetric
    difference, of which differing parity bits are a lower bound."""
    n = F.col("x.n") + F.col("y.n")
    apart = sum((F.bit_count(F.col(f"x.{p}").bitwiseXOR(F.col(f"y.{p}"))) for p in BITMAP), F.lit(0))
    overlap = F.ceil(F.lit(percent) * n / F.lit(100 + percent))
    sizes = F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent
    near = sizes & (apart <= n - 2 * overlap)
    if wide:
        each = F.zip_with("x.wide", "y.wide", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
        more = F.aggregate(each, F.lit(0), lambda total, bits: total + bits)
        near = near & (F.col("x.wide").isNull() | F.col("y.wide").isNull() | (more <= n - 2 * overlap))
    return near


def _shared_at_least(percent: int) -> Column:
    """Signatures that similar classes x, y share: of the prefix that ends first,
    ``n - least overlap + 1`` long, at most ``n - overlap`` are not in the
    other's. One if frequent shingles take part in a prefix."""
    overlap = F.ceil(F.lit(percent) * (F.col("x.n") + F.col("y.n")) / F.lit(100 + percent))
    least = overlap - F.ceil(F.lit(percent) * F.greatest("x.n", "y.n") / F.lit(100)) + 1
    return F.when(F.col("x.plain") & F.col("y.plain"), F.greatest(least, F.lit(1))).otherwise(1)


def _unsigned(sig: str) -> Column:
    """Orders signatures as unsigned numbers, of which tokens are: the rarest first."""
    return F.col(sig).bitwiseXOR(F.lit(-(1 << 63)))


def _last_first(n: Column, other: Column, percent: int) -> Column:
    """Last place of the first shingle that a set of n shares with a similar one
    of ``other``: as many as their least overlap start there."""
    return n - F.ceil(F.lit(percent) * (n + other) / F.lit(100 + percent))


def _may_be_first(percent: int) -> Column:
    """Whether classes x, y of one list may be similar without an earlier list in
    common: their places allow it, and none of the lists before it is one of both."""
    x, y = F.col("x.n"), F.col("y.n")
    places = (F.col("x.pos") <= _last_first(x, y, percent)) & (F.col("y.pos") <= _last_first(y, x, percent))
    return (~(F.col("x.plain") & F.col("y.plain")) | places) & ~F.arrays_overlap("x.before", "y.before")


def openings(lists: DataFrame, percent: int) -> DataFrame:
    """Rows of ``lists`` (sig, pos, cid, comp, n, plain) of several components that
    may be the first common one of a similar pair, with the component of the
    list's first member (``main``) and the class's ``BEFORE`` lists before it."""
    main = (
        lists.groupBy("sig")
        .agg(
            F.min("comp").alias("lo"),
            F.max("comp").alias("hi"),
            F.min(F.struct("pos", "cid", "comp")).alias("p"),
            F.min("n").alias("least"),
            F.bool_and("plain").alias("simple"),
        )
        .where("lo <> hi")
        .select("sig", "least", "simple", F.col("p.comp").alias("main"))
    )
    other = F.greatest("least", F.ceil(F.lit(percent) * F.col("n") / F.lit(100)))
    early = ~F.col("simple") | (F.col("pos") <= _last_first(F.col("n"), other, percent))
    some = written(lists.join(main, "sig").where(early).select("sig", "pos", "cid", "comp", "main"), "open-lists")
    before = Window.partitionBy("cid").orderBy(_unsigned("sig")).rowsBetween(-BEFORE, -1)
    return some.withColumn("before", F.collect_list("sig").over(before))


def meetings(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs x, y of classes of different components in one list that may be
    similar; every similar pair once or, where its lists lie far apart, a few times."""
    # members of the main component are on the right only; both sides read the same columns and rows, so one shuffle serves them
    together = (
        (F.col("x.sig") == F.col("y.sig"))
        & (F.col("x.comp") != F.col("y.comp"))
        & ((F.col("y.comp") == F.col("x.main")) | ((F.col("x.comp") != F.col("y.main")) & (F.col("x.cid") < F.col("y.cid"))))
        & _may_be_first(percent)
        & _likely(percent, wide=True)
    )
    return lists.alias("x").join(lists.alias("y"), together)


def sharing_enough(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that have as many signatures in common as similar ones."""
    need = written(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), "counted")
    if need.count() <= MAX_BROADCAST_SIGNATURES:
        need = F.broadcast(need)
    some = written(classes.select("cid", "n", "plain", F.when(F.col("plain"), F.col("sigs")).alias("sigs")).join(need, "cid", "left_semi"), "signatures")
    both = pairs.join(some.alias("x"), F.col("a") == F.col("x.cid")).join(some.alias("y"), F.col("b") == F.col("y.cid"))
    common = F.size(F.array_intersect("x.sigs", "y.sigs"))
    return both.where(~(F.col("x.plain") & F.col("y.plain")) | (common >= _shared_at_least(percent))).select("a", "b")


def merged_lists(listed: DataFrame) -> DataFrame:
    """``listed`` (sig, pos, cid; a class once in a list) with one signature, the
    rarest, of all that the same classes have, and their number as ``weight``."""
    members = [F.bit_xor(F.xxhash64(F.lit(i), F.col("cid"))).alias(f"h{i}") for i in range(2)]
    lists = listed.groupBy("sig").agg(F.count("*").alias("m"), *members)
    merged = lists.groupBy("m", "h0", "h1").agg(F.min_by("sig", _unsigned("sig")).alias("sig"), F.count("*").alias("weight")).select("sig", "weight")
    return written(listed.join(written(merged, "merged"), "sig"), "merged-lists")


def links_within(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """All similar pairs (a, b, both, either: shingles in both and in either
    set) among the rows of ``members`` (cid, component, digest) of one
    component. ``texts`` has (digest, text)."""
    sizes = members.groupBy("component").agg(F.count("*").alias("m")).where("m > 1")
    some = written(members.join(sizes, "component").select("component", "m", "cid", "digest"), "members")
    groups = -(-some.where(F.col("m") <= BLOCK).count() // BLOCK) + 1
    need = some.select("digest")
    if need.count() <= MAX_BROADCAST_SIGNATURES:
        need = F.broadcast(need)
    own = written(texts.join(need, "digest", "left_semi").dropDuplicates(["digest"]), "texts")
    blocks = F.ceil(F.col("m") / F.lit(BLOCK))
    mine = F.pmod(F.xxhash64("cid"), blocks)
    small = F.struct(F.lit(-1).cast("long").alias("c"), F.pmod(F.xxhash64("component"), F.lit(groups)).alias("lo"), F.lit(0).cast("long").alias("hi"))
    each = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.struct(F.col("component").alias("c"), F.least("mine", o).alias("lo"), F.greatest("mine", o).alias("hi")))
    dealt = some.withColumn("mine", F.when(F.col("m") > BLOCK, mine).otherwise(0))
    dealt = dealt.select("component", "cid", "mine", "digest", F.explode(F.when(F.col("m") > BLOCK, each).otherwise(F.array(small))).alias("key"))
    dealt = dealt.join(own, "digest").select("key.c", "key.lo", "key.hi", "component", "cid", "mine", "text")

    def run(group: pa.Table) -> pa.Table:
        c, lo, hi = (group.column(x)[0].as_py() for x in ("c", "lo", "hi"))
        data, offsets = text_buffer(group.column("text"))
        sets = []
        for a, b in text_ranges(offsets):
            w = Words(data, offsets[a : b + 1], NON_SPACE)
            sets += [np.unique(s) for s in _doc_shingles(w, w.hashes(), k)]
        n = np.array([len(s) for s in sets])
        bits = np.stack([np.bincount((mix(s) >> np.uint64(56)).astype(np.int64), minlength=256) & 1 for s in sets]).astype(bool)
        comp, cid, block = (group.column(x).to_numpy() for x in ("component", "cid", "mine"))
        out: list[tuple[int, int, int, int]] = []
        for i in range(len(sets)):
            fit = (comp == comp[i]) & (cid > cid[i])
            if c >= 0 and lo != hi:  # pairs within a block are those of its own group
                fit &= block != block[i]
            overlap = -(-percent * (n + n[i]) // (100 + percent))
            fit &= (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & ((bits != bits[i]).sum(axis=1) <= n + n[i] - 2 * overlap)
            for j in np.flatnonzero(fit).tolist():
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                either = int(n[i] + n[j]) - both
                if both and 100 * both >= percent * either:
                    out.append((int(cid[i]), int(cid[j]), both, either))
        return pa.table({x: pa.array([r[y] for r in out], pa.int64()) for y, x in enumerate(("a", "b", "both", "either"))})

    return dealt.groupBy("c", "lo", "hi").applyInArrow(run, "a bigint, b bigint, both bigint, either bigint")


def similarity_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(rows, links). Rows: those of ``near_duplicates`` with ``class`` (a number
    per class of equal sets, null for empty ones) and ``n_links``, the other rows
    that are similar to a row, copies included. Links: every pair of similar
    classes (a, b: their numbers, a < b; both, either: sizes of intersection and
    union). Rows of one class are similar to each other and to all rows of the
    classes that theirs is linked with."""
    with cut_scope(docs.sparkSession) as keep:
        rows, classes, texts = _near_duplicates(docs, doc_id, text, k, percent, numbered=True)
        rows = written(rows, "rows")
        members = rows.where("class is not null").groupBy("class").agg(F.first("component").alias("component"), F.count("*").alias("copies"))
        members = written(members.withColumnRenamed("class", "cid"), "copies")
        links = keep(links_within(members.join(classes.select("cid", "digest"), "cid"), texts, k, percent), "llm-links")
        ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("cid"), F.col("b").alias("o")), F.struct(F.col("b").alias("cid"), F.col("a").alias("o")))).alias("e")).select("e.*")
        others = ends.join(members.select(F.col("cid").alias("o"), "copies"), "o").groupBy("cid").agg(F.sum("copies").alias("linked"))
        counted = members.join(others, "cid", "left").select(F.col("cid").alias("class"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))
        rows = rows.join(counted, "class", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
        return keep(rows, "llm-similar-rows"), links


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, digest (MD5 of the text), n_shingles,
    class_id (smallest id with an equal set), component_id (smallest id
    reachable over links of at least ``percent`` similarity) and component (a
    number per component, also of those without an id; null for empty sets).
    Intermediate tables are deleted once the result is written."""
    with cut_scope(docs.sparkSession) as keep:
        return keep(_near_duplicates(docs, doc_id, text, k, percent)[0], "llm-near-duplicates")


def _near_duplicates(docs: DataFrame, doc_id: str, text: str, k: int, percent: int, numbered: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, with ``class`` if ``numbered``; classes; texts by digest)."""
    number = ["cid"] if numbered else []
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    texts = docs.select(F.unhex(F.md5("text")).alias("digest"), "text")
    rank, frequent = order_of(bucket_counts(docs, k))
    rows = written(sketches(docs, k, percent, rank, frequent), "sketches")

    # classes of equal sets: one row each, numbered
    firsts = [F.first(c).alias(c) for c in ("n", "plain", *BITMAP, "sigs", "pos", "wide")]
    classes = written(
        rows.where("n > 0")
        .groupBy("fp")
        .agg(F.min("doc_id").alias("least_id"), F.min("digest").alias("digest"), *firsts)
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    listed = classes.select("cid", F.explode(F.arrays_zip("sigs", "pos")).alias("s")).select("cid", F.col("s.sigs").alias("sig"), F.col("s.pos").alias("pos"))
    shared = written(listed.groupBy("sig").agg(F.count("*").alias("m")).where("m > 1").select("sig"), "shared")
    if shared.count() <= MAX_BROADCAST_SIGNATURES:
        shared = F.broadcast(shared)
    listed = merged_lists(written(listed.join(shared, "sig", "left_semi"), "listed"))
    sizes = classes.select("cid", "n", "plain", *BITMAP)
    digests = classes.select("cid", "digest")

    # first: every class against the member that most of its lists name, counted on narrow rows
    pivot = listed.groupBy("sig").agg(F.min(F.struct("pos", "cid")).alias("p")).select("sig", F.col("p.cid").alias("pid"))
    named = written(listed.join(written(pivot, "pivots"), "sig").where("cid <> pid").groupBy(F.col("cid").alias("own"), "pid").agg(F.sum("weight").alias("m")), "named")
    x, y = sizes.alias("x"), sizes.alias("y")
    named = named.join(x, F.col("own") == F.col("x.cid")).join(y, F.col("pid") == F.col("y.cid"))
    named = named.where(_likely(percent) & (F.col("m") * 2 >= _shared_at_least(percent)))
    # what shares too little even so is left to the rest, which counts all lists
    pair = F.struct(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b"))
    named = named.select("m", pair.alias("pair")).select(F.explode(F.array("pair.a", "pair.b")).alias("cid"), F.struct("m", "pair").alias("best"))
    first = written(named.groupBy("cid").agg(F.max("best").alias("best")).select("best.pair.*").distinct(), "first-pairs")

    def compared(pairs: DataFrame) -> DataFrame:
        """The similar ones of pairs (a, b)."""
        named = pairs.join(digests.select(F.col("cid").alias("a"), F.col("digest").alias("da")), "a")
        named = written(named.join(digests.select(F.col("cid").alias("b"), F.col("digest").alias("db")), "b"), "pairs")
        return verify(named.select("a", "b", "da", "db"), texts, k, percent)

    links = written(compared(first), "links")
    grouped = written(components(links), "components")
    # then: the rest between different components of one list
    node = grouped.select("node", "component")
    lists = listed.join(node, F.col("cid") == F.col("node"), "left").join(classes.select("cid", "n", "plain"), "cid")
    lists = written(lists.select("sig", "pos", "cid", F.coalesce("component", "cid").alias("comp"), "n", "plain"), "lists")
    lists = written(openings(lists, percent).join(classes.select(*sizes.columns, "wide"), "cid"), "open")
    rest = meetings(lists, percent).select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b"))
    rest = written(rest.distinct().join(first, ["a", "b"], "left_anti"), "rest-pairs")
    more = compared(sharing_enough(rest, classes, percent))
    # links of the rest join components, not single classes: contract first
    joined = (
        more.join(node.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
        .join(node.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    )
    merged = components(joined).select(F.col("node").alias("component"), F.col("component").alias("top"))

    named = (
        classes.select("cid", "fp", "least_id")
        .join(grouped, F.col("cid") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "cid"))
        .join(merged, "component", "left")
        .select("fp", "least_id", *number, F.coalesce("top", "component").alias("component"))
    )
    named = written(named, "named")
    smallest = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    labels = named.join(smallest, "component").select("fp", *number, "component", F.col("least_id").alias("class_id"), "component_id")
    found = (
        rows.select("doc_id", "digest", "fp", "n")
        .join(written(labels, "labels"), "fp", "left")
        .select(
            "doc_id",
            "digest",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.col("component").alias("component"),
            *[F.col(c).alias("class") for c in number],
        )
    )
    return found, classes, texts


def op3_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Components of all documents under 3-word shingles and a similarity of 0.9."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def ngram_links(spark, sf_dir: str) -> DataFrame:
    """How many other documents each is similar to, by all links of the join of ``op3``."""
    return similarity_join(table(spark, sf_dir, "documents"))[0].select("doc_id", "n_shingles", "component_id", "n_links")


_ASCII = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP3_SQL = rf"""
with recursive docs as (
  select doc_id, coalesce(regexp_extract_all({_ASCII}, '[^\x20\x09-\x0D]+'), []) as w from documents
), grams as (
  select distinct doc_id, array_to_string(list_slice(w, i, i + 2), ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from docs where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from grams group by doc_id
), both_of as (
  select x.doc_id as a, y.doc_id as b, count(*) as m
  from grams x join grams y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2
), links as (
  select a, b from both_of join sizes s on s.doc_id = a join sizes t on t.doc_id = b
  where 100 * m >= 90 * (s.n + t.n - m)
), edges as (
  select a, b from links union select b, a from links
), reach(doc_id, c) as (
  select doc_id, doc_id from docs
  union
  select e.a, r.c from reach r join edges e on e.b = r.doc_id
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
from (select doc_id, min(c) as component_id from reach group by doc_id) left join sizes using (doc_id)
"""

#: The same with the links of every document.
LINKS_SQL = OP3_SQL.replace("component_id\nfrom (", "component_id, coalesce(n_links, 0)::bigint as n_links\nfrom (") + """
left join (select a as doc_id, count(*) as n_links from edges group by a) using (doc_id)
"""
