"""Sentence ends learned from the corpus itself, without labels: statistics of
words and the full stops behind them (after Kiss and Strunk, "Unsupervised
multilingual sentence boundary detection", 2006), in Columns only.

A text is a run of words (anything between white space). A word's type is its
lower-cased text without quotes and brackets around it and marks behind it; a
number's type is ``#``. Three statistics are counted over all texts:

* *Abbreviations* (``abbreviation_scores``): a type is one if full stops follow
  it far more often than words in general, by a log-likelihood ratio that is
  damped for long types and for every time it stands without a full stop.
* *Starters* (``follower_scores``, left = ``""``): words that follow the sure ends
  of sentences far more often than they occur elsewhere.
* *Collocations* (``follower_scores``): words that stand behind an abbreviation,
  an initial or a number with a full stop more often than chance has it
  ("3. Oktober") and are no starters.

A line break ends a sentence, as do ``!`` and ``?`` before white space. A full stop
before white space does, unless its word is an abbreviation or one letter (then only
a capitalised starter begins a new one) or a number (it goes on before a lower-case
word or a collocation), and three dots do before a capital. Marks within
a word (``z.B.``, ``3.5``, an address) end nothing.

Counts are combined before they are shuffled, one row per type or pair leaves a
task. Scores are thousandths, rounded to whole numbers. The learned lists travel as
literals (hash buckets of types, found in constant time), so that texts are split
where they are: no join, no shuffle, no Python. A null text gives null, one of
white space only an empty array; nothing of a text but white space is lost."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordform.functions.text import NOT_WS, WS
from wordform.operators.joins import bounded_broadcast
from wordform.session import cut_lineage, cut_scope

OPENERS = "\"'([{<„“”‚‘»«›‹*_~"
CLOSERS = "\"')]}>“”’‘»«›‹*_~"
MARKS = ".,;:!?…"
#: The white space that ``WS`` matches, one by one.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
NUMBER = "#"
#: Bounds of the scores, as published, times 1000.
ABBREVIATION = 300
STARTER = 30_000
COLLOCATION = 7_880
#: Share of full stops behind an abbreviation.
DOTTED = 0.99
#: Entries of a model's lists. A model beyond it is refused; ``min_count`` makes it smaller.
MAX_ENTRIES = 1_000_000


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def pieces(text: Column) -> Column:
    """array<string>: words in order, each with the white space behind it."""
    return F.regexp_extract_all(text, F.lit(f"{NOT_WS}+{WS}*"), 0)


def word(piece: Column) -> Column:
    """A struct of a piece: ``type``, ``tail`` (the marks behind it), ``upper`` (it begins
    with a capital), ``last`` (a line break follows)."""
    core = F.ltrim(F.rtrim(piece, F.lit(SPACES + CLOSERS)), F.lit(OPENERS))

    def parts(c: Column) -> Column:
        bare = F.rtrim(c, F.lit(MARKS))
        kind = F.when(bare.rlike(r"^[0-9]+(?:[.,:][0-9]+)*$"), F.lit(NUMBER)).otherwise(F.lower(bare))
        return F.struct(
            kind.alias("type"),
            F.substring(c, F.length(bare) + 1, F.length(c)).alias("tail"),
            c.rlike(r"^\p{Lu}").alias("upper"),
            piece.contains("\n").alias("last"),
        )

    return _bind(core, parts)


def dotted(w: Column) -> Column:
    """One full stop stands behind the word, other than as the last of several."""
    return w["tail"].rlike(r"^\.[,;:]*$")


def counted(w: Column) -> Column:
    """Words that have a letter, and numbers, are types; the rest is punctuation."""
    return (w["type"] == NUMBER) | w["type"].rlike(r"\p{L}")


def closes(w: Column) -> Column:
    """The word ends with a mark that ends a sentence whatever the word is."""
    t = w["tail"]
    return t.rlike(r"[.!?]$") & ~t.rlike(r"^\.+$")


def initial(w: Column) -> Column:
    return w["type"].rlike(r"^\p{L}$")


def type_counts(docs: DataFrame, text: str) -> DataFrame:
    """(type, n, n_dot): how often a type occurs, and with a full stop."""
    # counted as they stand first, so that every distinct word is looked at once
    raw = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{NOT_WS}+"), 0)).alias("raw"))
    words = raw.groupBy("raw").agg(F.count(F.lit(1)).alias("n")).select("n", F.explode(F.array(word(F.col("raw")))).alias("w"))
    return words.where(counted(F.col("w"))).groupBy(F.col("w.type").alias("type")).agg(
        F.sum("n").alias("n"), F.sum(F.when(dotted(F.col("w")), F.col("n")).otherwise(0)).alias("n_dot")
    )


def _whole(score: Column) -> Column:
    return F.round(1000 * score).cast("long")


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """``counts`` with ``score`` and ``abbreviation``. With p = (dots + 1) / (words + 2) the
    log-likelihood ratio of ``DOTTED`` against p, times (inner dots + 1) / e^length, divided by
    length once for each time without a full stop; lengths without dots."""
    words, dots = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_dot"), F.lit(0))).first()
    p = (dots + 1) / (words + 2)
    n, k = F.col("n"), F.col("n_dot")
    ratio = 2 * (k * (math.log(DOTTED) - math.log(p)) + (n - k) * (math.log(1 - DOTTED) - math.log(1 - p)))
    letters = F.length(F.replace("type", F.lit("."), F.lit("")))
    inner = F.length("type") - letters
    damp = F.exp(-letters - (n - k) * F.log(letters))
    scored = counts.withColumn("score", _whole(ratio * (inner + 1) * damp))
    return scored.withColumn("abbreviation", (F.col("type") != NUMBER) & (F.col("score") >= ABBREVIATION))


def learned_abbreviations(counts: DataFrame, min_count: int = 2) -> list[str]:
    """Abbreviations with at least ``min_count`` full stops, at most ``MAX_ENTRIES``."""
    found = abbreviation_scores(counts).where(F.col("abbreviation") & (F.col("n_dot") >= min_count))
    return [r["type"] for r in _few(found.select("type"))]


def _log_likelihood(k: Column, n: Column, p: Column) -> Column:
    """ln(p^k * (1 - p)^(n - k)), 0 * ln(0) = 0."""
    return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when(n > k, (n - k) * F.log(1 - p)).otherwise(0.0)


def follower_scores(docs: DataFrame, text: str, counts: DataFrame, abbreviations: Iterable[str]) -> DataFrame:
    """(left, right, n_left, n_right, n_both, score): words behind an abbreviation, initial or number
    with a full stop, and (left = ``""``) behind other ends of sentences in a line. The score is the
    log-likelihood ratio of the pair, negative where it is rarer than chance has it.

    ``counts``: a written table of ``type_counts`` over the same texts."""
    known = _Types(abbreviations)

    def left(w: Column) -> Column:
        unsure = (w["type"] == NUMBER) | initial(w) | known.has(w["type"])
        return F.when(dotted(w) & unsure, w["type"]).when(closes(w) | (w["tail"] == "."), F.lit(""))

    def pair(w: Column, after: Column) -> Column:
        return F.when(counted(w) & ~w["last"] & counted(after), F.struct(left(w).alias("left"), after["type"].alias("right")))

    def pairs(ps: Column) -> Column:
        def found(p: Column, i: Column) -> Column:
            # words without a mark are no left side
            both = F.struct(word(p).alias("w"), word(F.get(ps, i + 1)).alias("after"))
            return F.when(p.rlike("[.!?]"), _bind(both, lambda x: pair(x["w"], x["after"])))

        return F.filter(F.transform(ps, found), lambda x: x["left"].isNotNull())

    rows = docs.select(F.inline(_bind(pieces(F.col(text)), pairs)))
    both = cut_lineage(rows.groupBy("left", "right").agg(F.count(F.lit(1)).alias("n_both")), "followers")
    lefts, _ = bounded_broadcast(both.groupBy("left").agg(F.sum("n_both").alias("n_left")))
    n = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rights = counts.select(F.col("type").alias("right"), F.col("n").alias("n_right"))
    t = both.join(lefts, "left").join(rights, "right")
    k1, n1, k2, n2 = F.col("n_both"), F.col("n_left"), F.col("n_right") - F.col("n_both"), n - F.col("n_left")
    p1, p2, p = k1 / n1, F.when(n2 > 0, k2 / n2).otherwise(0.0), F.col("n_right") / F.lit(n)
    ratio = 2 * (_log_likelihood(k1, n1, p1) + _log_likelihood(k2, n2, p2) - _log_likelihood(k1, n1, p) - _log_likelihood(k2, n2, p))
    score = F.when(p1 > p, ratio).otherwise(-ratio)
    return t.select("left", "right", "n_left", "n_right", "n_both", _whole(score).alias("score"))


class _Types:
    """A set of strings without spaces as a literal of hash buckets."""

    def __init__(self, types: Iterable[str]) -> None:
        self.types = sorted(set(types))
        self.size = len(self.types)

    def has(self, value: Column) -> Column:
        if not self.types:
            return F.lit(False)
        buckets: list[list[str]] = [[] for _ in self.types]
        for t in self.types:
            buckets[zlib.crc32(t.encode()) % self.size].append(t)
        table = F.split(F.lit("\n".join(f" {' '.join(b)} " for b in buckets)), "\n")
        bucket = F.get(table, (F.crc32(F.encode(value, "utf-8")) % self.size).cast("int"))
        return F.contains(bucket, F.concat(F.lit(" "), value, F.lit(" ")))


@dataclass(frozen=True)
class SentenceModel:
    """Learned lists. ``split`` is a sentence model for ``sentences`` and ``find_derivatives``."""

    abbreviations: frozenset[str] = field(default_factory=frozenset)
    starters: frozenset[str] = field(default_factory=frozenset)
    #: Words behind a number with a full stop.
    ordinals: frozenset[str] = field(default_factory=frozenset)

    @classmethod
    def fit(cls, docs: DataFrame, text: str, min_count: int = 2) -> SentenceModel:
        """Learned from all texts of ``docs``; a type, starter or collocation that occurs less
        than ``min_count`` times is none."""
        with cut_scope(docs.sparkSession):
            counts = cut_lineage(type_counts(docs, text), "types")
            abbreviations = learned_abbreviations(counts, min_count)
            pairs = follower_scores(docs, text, counts, abbreviations).where(F.col("n_both") >= min_count)
            needed = F.when(F.col("left") == "", STARTER).when(F.col("left") == NUMBER, COLLOCATION)
            rows = _few(pairs.where(F.col("score") >= needed).select("left", "right"))
        starters = frozenset(r["right"] for r in rows if r["left"] == "")
        # only those of numbers decide: an abbreviation goes on before any word but a starter
        pairs = frozenset(r["right"] for r in rows if r["left"] == NUMBER) - starters
        return cls(frozenset(abbreviations), starters, pairs)

    def ends(self, w: Column, after: Column) -> Column:
        """A sentence ends behind word ``w``, which ``after`` follows."""
        known, starters, ordinals = _Types(self.abbreviations), _Types(self.starters), _Types(self.ordinals)
        stop = (
            F.when(w["type"] == NUMBER, after["upper"] & ~ordinals.has(after["type"]))
            .when(initial(w) | known.has(w["type"]), after["upper"] & starters.has(after["type"]))
            .otherwise(True)
        )
        return (
            F.when(w["last"], True)
            .when(w["tail"] == ".", stop)
            .when(w["tail"].rlike(r"^(?:\.{2,}|…)$"), after["upper"])
            .otherwise(closes(w))
        )

    def split(self, text: Column) -> Column:
        """array<string>: the sentences of a text, white space within them as it was."""

        def whole(ps: Column) -> Column:
            return _bind(F.filter(F.transform(ps, lambda p, i: end(ps, p, i)), lambda i: i.isNotNull()), lambda at: cut(ps, at))

        def end(ps: Column, p: Column, i: Column) -> Column:
            # most words have neither mark nor line break and are not looked at further
            both = F.struct(word(p).alias("w"), word(F.get(ps, i + 1)).alias("after"))
            closed = _bind(both, lambda x: self.ends(x["w"], x["after"]))
            return F.when(i == F.size(ps) - 1, i).when(p.rlike("[.!?…\n]"), F.when(closed, i))

        def cut(ps: Column, at: Column) -> Column:
            def sentence(end: Column, k: Column) -> Column:
                begin = F.coalesce(F.get(at, k - 1) + 1, F.lit(0))
                return F.rtrim(F.array_join(F.slice(ps, begin + 1, end - begin + 1), ""), F.lit(SPACES))

            return F.transform(at, sentence)

        return _bind(pieces(text), whole)


def _few(rows: DataFrame) -> list:
    """Rows of a model's list on the driver, at most ``MAX_ENTRIES``."""
    found = rows.limit(MAX_ENTRIES + 1).collect()
    if len(found) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} entries; raise min_count")
    return found
