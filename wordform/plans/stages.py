"""The corpus stages as DataFrame plans.

filter_comments  dump rows ⋉ communities → clean → length → language
find_derivatives comments → sentences → tokens → types → analyses,
                 then occurrences with context (long) and counts (summary)
merge_months     monthly summaries → one table (see operators.corpus)
productivity     V / N / hapax per affix (see operators.metrics)
make_corpora     bins × sentence-level rows → SHARED and SPLIT train/test/dev
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordform.functions.text import sanitize_body, sanitize_text
from wordform.operators.analyze import ANALYSIS_COLS, Resources, analyze, gated_counts, prepare
from wordform.operators.bloom import BloomFilter
from wordform.operators.corpus import merge_months, wide_contexts
from wordform.operators.filters import body_length_ok, community_filter, lang_filter, once
from wordform.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES, table_size
from wordform.operators.metrics import observe_rows, productivity
from wordform.operators.segment import sentences, tokens
from wordform.operators.splits import SIZE_TEST, SIZE_TRAIN, sentence_rows, shared_split, split_by_key
from wordform.session import cut_lineage, cut_scope


def filter_comments(
    comments: DataFrame,
    communities: DataFrame | None,
    lang: str | None = "de",
    min_chars: int = 31,
    scorer=None,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    spread: int | None = None,
) -> DataFrame:
    """Comments of the listed communities whose cleaned body has at least
    ``min_chars`` characters and whose language is ``lang``.

    ``spread``: partitions to deal the rows over once community and length
    have been tested, for sources with one task per unsplittable file.

    Cheap predicates run first; a user language model (``scorer``) runs last
    because Catalyst cannot move filters across a Python UDF. Adds
    ``clean_body``; all input columns (including ``raw``) pass through.

    ``clean_body`` and the language label are produced by one-row
    generators: filters on them then read the computed value instead of
    having Catalyst inline the clean-up regex into every pushed-down predicate
    (measured 4x faster at sf0.1).
    """
    df = comments
    if communities is not None:
        df = community_filter(df, communities, max_broadcast_rows=max_broadcast_rows)
    df = once(df, sanitize_body(F.col("body")).alias("clean_body"))
    df = df.where(body_length_ok(F.col("clean_body"), min_chars))
    if spread:
        df = df.repartition(spread)
    if lang is not None:
        df = lang_filter(df, "clean_body", lang, scorer=scorer)
    return df


class Derivatives:
    """``analyses``: one row per derivative token (with its count when there are no
    group columns); ``summary``: group columns, token, analysis, count; ``long``: one
    row per occurrence with group and key columns, sent_pos, tok_pos, analysis and
    context, planned when it is first asked for."""

    def __init__(self, analyses: DataFrame, summary: DataFrame, contexts: Callable[[], DataFrame]):
        self.analyses, self.summary, self._contexts = analyses, summary, contexts

    @cached_property
    def long(self) -> DataFrame:
        return self._contexts()


def find_derivatives(
    docs: DataFrame,
    affixes: DataFrame,
    lexicon: DataFrame | None,
    vocab: DataFrame | None,
    *,
    require_vocab: bool = True,
    key_cols: tuple[str, ...] = ("doc_id",),
    text: str = "body",
    group_cols: tuple[str, ...] = (),
    full_unescape: bool = True,
    materialize: bool = True,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    sentence_model=None,
    token_model=None,
    resources: Resources | None = None,
) -> Derivatives:
    """Find derivatives in ``docs[text]``.

    Two passes over the documents instead of one shuffle of all text: pass 1
    tokenises, drops vocabulary words and counts tokens per group (partial
    aggregation, ``gated_counts``); the counts and the analyses of the
    distinct tokens are written to the checkpoint folder. Pass 2 tokenises
    again with each token carrying its sentence and keeps derivative tokens
    (``occurrences``), so only they are cleaned and kept as contexts. Every
    occurrence gives one context, whatever the keys: nothing is joined back by
    a user's key.
    """
    group_cols = list(group_cols)
    keys = group_cols + [k for k in key_cols if k not in group_cols]
    res = resources or prepare(affixes, lexicon, vocab, require_vocab, materialize, max_broadcast_rows)

    sents = sentences(docs, keys, text, sentence_model=sentence_model, token_model=token_model)
    counts = gated_counts(tokens(sents, keys), res, group_cols)
    if materialize and group_cols:
        counts = cut_lineage(counts, "token-counts")
    types = counts if not group_cols else counts.groupBy("token").agg(F.sum("count").alias("count"))
    analyses = analyze(types, resources=res, gate=False)
    if materialize:
        analyses = cut_lineage(analyses, "analyses")
    if group_cols:
        summary = counts.join(analyses.drop("count"), "token", "inner")
    else:
        summary = analyses

    def contexts() -> DataFrame:
        long = occurrences(sents, keys, analyses, max_broadcast_rows)
        long = long.withColumn("context", sanitize_text(F.col("sentence"), full_unescape=full_unescape))
        return long.select(*keys, "sent_pos", "tok_pos", *ANALYSIS_COLS, "context")

    return Derivatives(analyses.drop("count") if group_cols else analyses, summary, contexts)


def occurrences(sents: DataFrame, keys: list[str], analyses: DataFrame, max_rows: int) -> DataFrame:
    """Every occurrence of an analysed token with its sentence.

    ``analyses`` (written, with ``count``) that fit the broadcast bounds are
    broadcast. Of more, the most frequent ones that fit still are: they are
    the hot tokens and nearly all occurrences. The others are rare by
    construction, so their occurrences are joined by token without skew, and of
    the other tokens only those that a Bloom filter of the rare ones lets through
    are moved at all.
    """
    toks = tokens(sents, keys, carry=["sentence"])
    small = analyses.select(*ANALYSIS_COLS)
    n, size = table_size(small)
    if n <= max_rows and size <= MAX_BROADCAST_BYTES:
        return toks.join(F.broadcast(small), "token", "inner")
    fit = min(max_rows, int(MAX_BROADCAST_BYTES * n / max(size, 1)))
    # counts above this one have at most about ``fit`` analyses
    (least,) = analyses.agg(F.percentile_approx("count", F.lit(1 - fit / n), F.lit(10_000))).first()
    frequent = F.broadcast(analyses.where(F.col("count") > least).select(*ANALYSIS_COLS))
    rare = analyses.where(F.col("count") <= least).select(*ANALYSIS_COLS)
    others = toks.join(frequent.select("token"), "token", "left_anti")
    possible = BloomFilter.of(rare.select("token"), n).probed(others, F.col("token"), "_may").where("_may").drop("_may")
    return toks.join(frequent, "token", "inner").unionByName(possible.join(rare, "token", "inner"))


def make_corpora(
    long: DataFrame,
    summary: DataFrame,
    key_cols: tuple[str, ...] = ("doc_id",),
    seed: int = 200,
    bins: str = "overlap",
    materialize: bool = True,
    clean=None,
) -> DataFrame:
    """SHARED and SPLIT train/test/dev corpora for every (mode, bin).

    The sentence-level rows are written to the checkpoint folder first: the
    exact-size split reads them several times (bucket counts, settled rows,
    cut buckets), and re-reading a written table is cheaper than recomputing
    the derivative search. ``clean`` is an optional user DataFrame →
    DataFrame step applied to the summary first (manual cleaning)."""
    if clean is not None:
        summary = clean(summary)
    rows = sentence_rows(long, summary, bins=bins)
    if materialize:
        rows = cut_lineage(rows)
    g = ["mode", "bin"]
    unit = ["token", *key_cols, "sent_pos", "tok_pos"]
    shared = shared_split(rows, g, unit, seed, SIZE_TRAIN, SIZE_TEST).withColumn("condition", F.lit("shared"))
    by_base = split_by_key(rows, g, "base", seed).withColumn("condition", F.lit("split_base"))
    by_stem = split_by_key(rows, g, "stem", seed).withColumn("condition", F.lit("split_stem"))
    return shared.unionByName(by_base).unionByName(by_stem)


def run_corpus(
    spark,
    dumps: str,
    communities: str,
    prefixes: str,
    suffixes: str,
    lexicon: str | None,
    vocab: str | None,
    out: str,
    *,
    require_vocab: bool = True,
    long_window: bool = False,
    lang: str = "de",
) -> dict:
    """All stages over every monthly dump under ``dumps``, writing each
    stage's table under ``out`` (filtered/, derivatives/, contexts/, joined/,
    joined_contexts/, productivity/, corpus/). Months are partition columns
    throughout; the tables from joined/ on are made from all months there are
    and replaced as a whole. Intermediate tables are deleted at the end, also
    after a failure. Returns the progress counters (comments read / corrupt /
    kept)."""
    from wordform import sinks
    from wordform.sources.comments import read_comments, read_filtered_comments, spread_partitions
    from wordform.sources.lexicon import read_lexicon
    from wordform.sources.lists import read_affixes, read_communities, read_vocab

    with cut_scope(spark):
        comments, seen = observe_rows(read_comments(spark, dumps, long_window=long_window), "comments")
        spread = spread_partitions(spark, dumps) if long_window else None
        kept = filter_comments(comments.where(~F.col("corrupt")), read_communities(spark, communities), lang=lang, spread=spread)
        kept, kept_obs = observe_rows(kept, "kept")
        sinks.write_filtered_comments(kept, f"{out}/filtered")
        progress = {"comments": seen.get, "kept": kept_obs.get}
        # re-read the written table: lineage cut, months are partition columns
        filtered = read_filtered_comments(spark, f"{out}/filtered")
        res = find_derivatives(
            filtered,
            read_affixes(spark, prefixes, suffixes),
            read_lexicon(spark, lexicon) if lexicon else None,
            read_vocab(spark, vocab) if vocab else None,
            require_vocab=require_vocab,
            key_cols=("id",),
            group_cols=("year", "month"),
        )
        sinks.write_derivatives(res.summary, f"{out}/derivatives")
        sinks.write_derivatives(res.long, f"{out}/contexts")
        monthly = spark.read.parquet(f"{out}/derivatives")
        sinks.write_joined(merge_months([monthly.drop("year", "month")]), f"{out}/joined")
        merged = spark.read.parquet(f"{out}/joined")
        sinks.write_productivity(productivity(merged, ["prefix", "suffix"]), f"{out}/productivity")
        long = spark.read.parquet(f"{out}/contexts")
        sinks.write_joined(wide_contexts(long, ["year", "month", "id", "sent_pos", "tok_pos"]), f"{out}/joined_contexts")
        sinks.write_corpora(make_corpora(long, merged, key_cols=("year", "month", "id")), f"{out}/corpus")
    return progress
