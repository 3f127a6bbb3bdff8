"""Comment filters: community semi-join, body length, language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordform.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, sized_broadcast

# Stop words of the default language scorer, in tie order.
STOP_WORDS = {
    "de": "der die das und ist nicht ein den von zu mit sich auf für im dem des als auch".split(),
    "en": "the of and to in is that it for was on are as with they be at this have from".split(),
    "fr": "le la les de des et un une est que qui dans pour en il elle du au ne pas".split(),
    "es": "el la los las de que y en un una por con para es no se del al lo como".split(),
}
NON_WORD_RE = r"\P{L}+"


def community_filter(df: DataFrame, communities: DataFrame, col: str = "subreddit",
                     max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Keep rows whose community is listed (exact case): a left-semi join,
    broadcast when the list is proven small."""
    c = communities.select(F.col(communities.columns[0]).alias("_community"))
    c = sized_broadcast(c, max_broadcast_rows)
    return df.join(c, df[col] == c["_community"], "left_semi")


def body_length_ok(clean_body: Column, min_chars: int = 31) -> Column:
    """At least ``min_chars`` characters and not a deleted marker."""
    return (F.length(clean_body) >= min_chars) & (clean_body != "[deleted]")


def _argmax_language(counts: dict[str, Column]) -> Column:
    """Language with the highest count, earlier language on ties, null if
    every count is 0; each count is referenced once."""
    n = len(counts)
    entries = [
        F.struct(c.alias("c"), F.lit(n - i).alias("prio"), F.lit(lang).alias("lang"))
        for i, (lang, c) in enumerate(counts.items())
    ]
    entries.append(F.struct(F.lit(0).alias("c"), F.lit(n + 1).alias("prio"), F.lit(None).cast("string").alias("lang")))
    return F.array_max(F.array(*entries)).getField("lang")


def detect_language(df: DataFrame, text: str, out: str = "lang_pred",
                    stop_words: dict[str, list[str]] | None = None) -> DataFrame:
    """Add ``out``: the language whose stop words occur most often among the
    lower-cased words (maximal letter runs); ties go to the earlier language;
    null if no stop word occurs.

    The text is split at non-letters once and reduced to its stop words
    (through a one-row generator, so it is evaluated once); per-language counts
    run over that short array."""
    stop_words = stop_words or STOP_WORDS
    every = sorted({w for ws in stop_words.values() for w in ws})
    found = "_stop_words_found"
    words = F.split(F.lower(F.col(text)), NON_WORD_RE)
    df = once(df, F.filter(words, lambda w: w.isin(every)).alias(found))

    def hits(sw: list[str]) -> Column:
        return F.size(F.filter(F.col(found), lambda w: w.isin(sorted(set(sw)))))

    label = _argmax_language({lang: hits(sw) for lang, sw in stop_words.items()})
    return df.withColumn(out, label).drop(found)


def once(df: DataFrame, *cols: Column) -> DataFrame:
    """Add computed columns through a one-row ``inline`` generator.

    Catalyst pushes filters below projections by substituting the projected
    expression into the predicate, so an expensive column used by several
    predicates would be re-evaluated for each; a generator output is
    computed once per row and cannot be inlined."""
    return df.select("*", F.inline(F.array(F.struct(*cols))))


def lang_filter(df: DataFrame, text: str, lang: str = "de", scorer=None, lang_col: str | None = None) -> DataFrame:
    """Keep rows whose detected language is ``lang``.

    ``scorer``: optional user ``pandas_udf`` (string → label); default is the
    stop-word scorer. ``lang_col``: use an existing label column instead.
    """
    if lang_col is not None:
        return df.where(F.col(lang_col) == F.lit(lang))
    if scorer is not None:
        return df.where(scorer(F.col(text)) == F.lit(lang))
    labelled = detect_language(df, text, "_lang")
    return labelled.where(F.col("_lang") == F.lit(lang)).drop("_lang")
