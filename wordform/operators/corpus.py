"""Derivative tables: occurrences with context (long form), per-token counts,
month merge, duplicate analyses, review sample, wide export.

The long table (one row per occurrence) is the canonical form: context lists
per token are skewed (a frequent derivative has millions of contexts), so
they are never collected into one row except by ``wide_contexts``, which deals
the contexts of a frequent one over several rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordform.session import cut_lineage

NULL_KEY = "\u2400"
ANALYSIS_KEYS = ["token", "affix", "base", "in_lexica", "stem", "mode"]


def merge_months(tables: list[DataFrame], extra_keys: tuple[str, ...] = ("prefix", "suffix")) -> DataFrame:
    """Union monthly per-token tables and sum their counts per analysis.

    Groups on token, affix, base, in_lexica, stem, mode (nulls are keys);
    ``prefix``/``suffix`` are functions of affix+mode and ride along.
    Partial aggregation runs map-side, so a hot token costs one row per map
    task in the shuffle.
    """
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    keys = ANALYSIS_KEYS + [k for k in extra_keys if k in u.columns]
    return u.groupBy(*keys).agg(F.sum("count").alias("count"))


def merge_increment(merged: DataFrame, new_month: DataFrame) -> DataFrame:
    """Fold one more month into a merged table without re-reading old months
    (the merge is associative)."""
    return merge_months([merged, new_month])


def duplicate_analyses(merged: DataFrame) -> DataFrame:
    """Rows whose token has more than one analysis after a merge, by token.

    The window groups rows of one token only; a token has at most one row per
    distinct analysis, so the group stays small."""
    from pyspark.sql import Window

    n = F.count(F.lit(1)).over(Window.partitionBy("token"))
    return merged.withColumn("n_analyses", n).where(F.col("n_analyses") > 1).drop("n_analyses").orderBy("token")


def review_sample(merged: DataFrame, n: int = 100, seed: int = 0) -> DataFrame:
    """``n`` rows in a seeded hash order (top-k, not a full sort)."""
    h = F.md5(
        F.concat_ws(
            "|",
            F.lit(str(seed)),
            *[F.coalesce(F.col(k).cast("string"), F.lit(NULL_KEY)) for k in ANALYSIS_KEYS],
        )
    )
    return merged.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")


def wide_contexts(long: DataFrame, key_cols: list[str], max_per_row: int = 10_000) -> DataFrame:
    """The reference's list-of-contexts layout: one row per analysis with its
    whole ``count`` and its contexts; an analysis with more than
    ``max_per_row`` contexts has them dealt over ``n_parts`` rows (``part`` from
    0, ``part_count`` contexts in this one).

    Months need no merging first: the contexts of all months of ``long`` that
    have one analysis (nulls are keys) come together, and counts are taken from
    ``long`` itself. ``part`` is an md5 of the occurrence key modulo
    ``n_parts``, so parts hold about ``max_per_row`` contexts each (at most about
    a few per cent more) and no task collects a whole hot token. Contexts inside
    a row follow the occurrence key order.
    """
    from wordform.operators.joins import bounded_broadcast

    keys = [k for k in ANALYSIS_KEYS if k in long.columns]
    # at most len(long) / max_per_row analyses have more than one part
    heavy = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_per_row)
    heavy = cut_lineage(
        heavy.select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_n", F.ceil(F.col("_n") / F.lit(max_per_row)).cast("int").alias("_parts")),
        "heavy-analyses",
    )
    heavy, _ = bounded_broadcast(heavy)
    occ = long.join(heavy, [long[k].eqNullSafe(heavy[f"_h_{k}"]) for k in keys], "left")
    # part: first 32 bits of md5 over the occurrence key (reproducible in SQL)
    named = [F.coalesce(F.col(k).cast("string"), F.lit(NULL_KEY)) for k in key_cols]
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *named)), 1, 8), 16, 10)
    occ = occ.withColumn("n_parts", F.coalesce("_parts", F.lit(1)))
    occ = occ.withColumn("part", F.pmod(h.cast("long"), F.col("n_parts")).cast("int"))
    order = F.struct(*key_cols, F.col("context"))
    g = occ.groupBy(*keys, "part", "n_parts", "_n").agg(
        F.count(F.lit(1)).alias("part_count"),
        F.array_sort(F.collect_list(order)).alias("_c"),
    )
    return g.select(
        *keys, "part", "n_parts", F.coalesce("_n", "part_count").alias("count"), "part_count",
        F.transform("_c", lambda x: x["context"]).alias("context"),
    )
