"""Frequency bins and reproducible train/test/dev corpora.

Sizes follow the reference exactly; members follow a seeded md5 order (the
same in Spark and DuckDB), not NumPy's generator.

Scale: there are only a few (mode, bin) groups, so ranking with a plain
``row_number`` window would send a whole group to one task. ``exact_split``
instead counts units per (group, hash bucket), takes running sums over that
small table, labels every bucket that lies entirely inside one split at once
(broadcast join, no shuffle of the rows), and ranks only the rows of the at
most two buckets per group that straddle a cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordform.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, bounded_broadcast
from wordform.session import cut_lineage

# Frequency bins (inclusive bounds, None = open); 64 lies in
# bins 6 and 7.
BINS = [(1, 1, 1), (2, 2, 3), (3, 4, 7), (4, 8, 15), (5, 16, 31), (6, 32, 64), (7, 64, 127), (8, 128, None)]
BINS_DISJOINT = [(1, 1, 1), (2, 2, 3), (3, 4, 7), (4, 8, 15), (5, 16, 31), (6, 32, 63), (7, 64, 127), (8, 128, None)]

MODES = ["prefix", "suffix", "both"]
# (mode, bin) groups: the proven bound of the split bucket tables
MODE_BIN_GROUPS = len(MODES) * len(BINS)

SIZE_TRAIN = 0.8
SIZE_TEST = 0.15
HASH_BUCKET_HEX = 4  # 65 536 buckets per group
NULL_KEY = "\u2400"


def frequency_bins(df: DataFrame, count_col: str = "count", bins: str = "overlap") -> DataFrame:
    """Add ``bin``; a row whose count lies in two bins appears twice."""
    table = BINS if bins == "overlap" else BINS_DISJOINT
    arr = F.array(
        *[
            F.struct(F.lit(b).alias("bin"), F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi"))
            for b, lo, hi in table
        ]
    )
    c = F.col(count_col)
    hits = F.filter(arr, lambda x: (x["lo"] <= c) & (x["hi"].isNull() | (c <= x["hi"])))
    return df.withColumn("bin", F.explode(F.transform(hits, lambda x: x["bin"])))


def unit_hash(seed: int, group_cols: list[str], key_cols: list[str]) -> F.Column:
    parts = [F.lit(str(seed))] + [F.col(g).cast("string") for g in group_cols] + [
        F.coalesce(F.col(k).cast("string"), F.lit(NULL_KEY)) for k in key_cols
    ]
    return F.md5(F.concat_ws("|", *parts))


def exact_split(
    units: DataFrame,
    group_cols: list[str],
    hash_col: str,
    train_size,
    test_size,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_groups: int | None = None,
) -> DataFrame:
    """Label units train/test/dev: in each group the ``train_size(N)`` units
    first in ``hash_col`` order are train, the next ``test_size(N, n_train)``
    test, the rest dev. ``train_size``/``test_size`` are Column functions of
    the group size. Adds ``split``.

    The bucket table has at most groups × 65 536 rows; with a known
    ``max_groups`` that bound is the size proof for its broadcast, otherwise
    the table is counted first."""
    bucket = F.conv(F.substring(F.col(hash_col), 1, HASH_BUCKET_HEX), 16, 10).cast("int")
    u = units.withColumn("_bucket", bucket)
    stats = u.groupBy(*group_cols, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*group_cols).orderBy("_bucket")
    stats = stats.withColumn("_end", F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    stats = stats.withColumn("_start", F.col("_end") - F.col("_cnt"))
    stats = stats.withColumn("_n", F.sum("_cnt").over(Window.partitionBy(*group_cols)))
    n = F.col("_n")
    n_train = train_size(n).cast("long")
    stats = stats.withColumn("_cut1", n_train).withColumn("_cut2", F.col("_cut1") + test_size(n, F.col("_cut1")).cast("long"))
    s, e, c1, c2 = F.col("_start"), F.col("_end"), F.col("_cut1"), F.col("_cut2")
    label = (
        F.when(e <= c1, "train")
        .when((s >= c1) & (e <= c2), "test")
        .when(s >= c2, "dev")
    )
    stats = stats.select(*group_cols, "_bucket", "_start", "_cut1", "_cut2", label.alias("_label"))
    if max_groups is not None and max_groups * 16**HASH_BUCKET_HEX <= max_broadcast_rows:
        stats = F.broadcast(stats)
    else:
        stats, _ = bounded_broadcast(cut_lineage(stats, "split-buckets"), max_broadcast_rows)
    joined = u.join(stats, [*group_cols, "_bucket"], "inner")
    settled = joined.where(F.col("_label").isNotNull()).withColumn("split", F.col("_label"))
    cut = joined.where(F.col("_label").isNull())
    r = F.row_number().over(Window.partitionBy(*group_cols, "_bucket").orderBy(hash_col))
    cut = cut.withColumn("_rank", F.col("_start") + r - 1)
    cut = cut.withColumn(
        "split",
        F.when(F.col("_rank") < F.col("_cut1"), "train").when(F.col("_rank") < F.col("_cut2"), "test").otherwise("dev"),
    ).drop("_rank")
    drop = ["_bucket", "_start", "_cut1", "_cut2", "_label"]
    return settled.drop(*drop).unionByName(cut.drop(*drop))


def _shared_sizes(size_train: float, size_test: float):
    rest_fraction = size_test / (1 - size_train)
    return (
        lambda n: F.rint(F.lit(size_train) * n),
        lambda n, n_train: F.rint(F.lit(rest_fraction) * (n - n_train)),
    )


def _split_sizes(size_train: float, size_test: float):
    return (
        lambda n: F.floor(F.lit(size_train) * n),
        lambda n, n_train: F.floor(F.lit(size_test) * n),
    )


def shared_split(rows: DataFrame, group_cols: list[str], key_cols: list[str], seed: int = 200,
                 size_train: float = SIZE_TRAIN, size_test: float = SIZE_TEST) -> DataFrame:
    """SHARED: split sentence-level rows inside each group; n_train =
    round(0.8·N), n_test = round(0.15/(1−0.8)·(N − n_train)), rest dev."""
    tr, te = _shared_sizes(size_train, size_test)
    r = rows.withColumn("_h", unit_hash(seed, group_cols, key_cols))
    groups = MODE_BIN_GROUPS if sorted(group_cols) == ["bin", "mode"] else None
    return exact_split(r, group_cols, "_h", tr, te, max_groups=groups).drop("_h")


def split_by_key(rows: DataFrame, group_cols: list[str], key: str, seed: int = 200,
                 size_train: float = SIZE_TRAIN, size_test: float = SIZE_TEST,
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """SPLIT: the distinct values of ``key`` (null counts as one value) are
    split floor(0.8·K) / floor(0.15·K) / rest inside each group, then rows
    with a null key are dropped and every row takes its key's split."""
    keys = rows.select(*group_cols, key).distinct()
    keys = keys.withColumn("_h", unit_hash(seed, group_cols, [key]))
    tr, te = _split_sizes(size_train, size_test)
    groups = MODE_BIN_GROUPS if sorted(group_cols) == ["bin", "mode"] else None
    # written once: it is measured, then joined
    keys = cut_lineage(keys, "split-keys")
    labelled = exact_split(keys, group_cols, "_h", tr, te, max_groups=groups).drop("_h").where(F.col(key).isNotNull())
    labelled, _ = bounded_broadcast(cut_lineage(labelled, "split-labels"), max_broadcast_rows)
    return rows.where(F.col(key).isNotNull()).join(labelled, [*group_cols, key], "inner")


def sentence_rows(long: DataFrame, summary: DataFrame, bins: str = "overlap",
                  max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """One row per (derivative occurrence, bin): the long table with the
    ``count`` and ``bin`` of its derivative row."""
    keys = ["token", "affix", "base", "in_lexica", "stem", "mode"]
    # fresh names: long and summary may share lineage (same analyses)
    binned = frequency_bins(
        summary.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col("count").alias("_s_count")),
        count_col="_s_count", bins=bins,
    )
    binned, _ = bounded_broadcast(cut_lineage(binned, "binned"), max_broadcast_rows)
    cond = [long[k].eqNullSafe(binned[f"_s_{k}"]) for k in keys]
    return long.join(binned, cond, "inner").select(
        long["*"], binned["_s_count"].alias("count"), binned["bin"]
    )
