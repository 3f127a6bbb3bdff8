"""A language scorer learned from labelled texts: multinomial over hashed
character n-grams, in Columns only.

A text is lower-cased, its runs of non-letters become one space, and it gets a
space at either end; its features are all runs of ``NGRAM`` characters, hashed
to ``BUCKETS`` buckets. A language's weight of a bucket is
floor(1000 * ln((n + 1) / (N + BUCKETS))) with n of its N n-grams in the bucket;
the label is the language with the largest sum of weights, the first in order on
ties. Whole numbers make the sums the same in any order of rows.

Learning is one aggregate, combined before it is shuffled, down to languages x
``BUCKETS`` rows. These travel as one array literal, so that a text is scored where it is:
no join, no shuffle, no Python. Texts without a letter, and null ones, get null;
every other text gets a label. Letters beyond the basic plane count as one and the same."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NGRAM = 3
BUCKETS = 8192
#: Factor of the n-gram hash.
FACTOR = 131
#: Languages of one model; 512 of them are 4 M weights.
MAX_LANGUAGES = 512
NON_LETTERS = r"\P{L}+"
BEYOND_BASIC = r"[\x{10000}-\x{10FFFF}]"
STAND_IN = "\ufffd"


def normalized(text: Column) -> Column:
    """Lower-case letter runs between single spaces, a space at either end."""
    letters = F.regexp_replace(F.lower(text), NON_LETTERS, " ")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(letters, BEYOND_BASIC, STAND_IN)), F.lit(" "))


def buckets(text: Column) -> Column:
    """array<int>: the bucket of every n-gram of the text, in order. Each character is
    turned into its number once, and n-grams are hashed from the array of these."""

    def hashed(codes: Column) -> Column:
        def value(first: Column, at: Column) -> Column:
            for i in range(1, NGRAM):
                first = first * FACTOR + codes[at + i]
            return first % BUCKETS

        return F.transform(F.slice(codes, 1, F.greatest(F.size(codes) - (NGRAM - 1), F.lit(0))), value)

    codes = F.transform(F.split(normalized(text), ""), F.ascii)
    # a one-element array keeps the numbers from being worked out once per n-gram
    return F.transform(F.array(codes), hashed)[0]


def language_weights(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """The model as a table (lang, bucket, weight), one row for every language and
    bucket, learned from the rows of ``labelled`` that have a text and a language."""
    known = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    grams = known.select("lang", F.explode(buckets(F.col("text"))).alias("bucket"))
    counts = grams.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # at most BUCKETS entries a language
    per_lang = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("seen"), F.sum("n").alias("total"))
    unseen = F.array_except(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), F.col("seen.bucket"))
    unseen = F.transform(unseen, lambda b: F.struct(b.alias("bucket"), F.lit(0).cast("long").alias("n")))
    every = per_lang.select("lang", "total", F.inline(F.concat("seen", unseen)))
    share = (F.col("n") + 1) / (F.col("total") + BUCKETS)
    return every.select("lang", "bucket", F.floor(1000 * F.log(share)).cast("long").alias("weight"))


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, and their weights bucket by bucket.

    ``label`` is a scorer for ``lang_filter`` and ``filter_comments``."""

    languages: tuple[str, ...]
    weights: tuple[int, ...]

    @classmethod
    def from_weights(cls, table: DataFrame) -> LanguageModel:
        """From a table of ``language_weights``: ``BUCKETS`` rows a language, at most
        ``MAX_LANGUAGES`` of them, whatever the corpus."""
        # codepoint order, as Python sorts strings and Spark compares them
        per_lang = table.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "weight"))).alias("w"))
        rows = sorted(per_lang.select("lang", "w.weight").limit(MAX_LANGUAGES + 1).collect(), key=lambda r: r["lang"])
        if len(rows) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        if any(len(r["weight"]) != BUCKETS for r in rows):
            raise ValueError(f"a language needs {BUCKETS} weights")
        flat = tuple(w for bucket in zip(*(r["weight"] for r in rows)) for w in bucket)
        return cls(tuple(r["lang"] for r in rows), flat)

    @classmethod
    def fit(cls, labelled: DataFrame, text: str, lang: str) -> LanguageModel:
        return cls.from_weights(language_weights(labelled, text, lang))

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> LanguageModel:
        return cls.from_weights(spark.read.parquet(path))

    def scores(self, text: Column) -> Column:
        """A struct with a sum of weights per language (s0, s1, ...)."""
        names = [f"s{i}" for i in range(len(self.languages))]
        per_bucket = zip(*[iter(self.weights)] * len(names))
        # one string, folded into an array once, instead of a literal per weight; a bucket's weights are looked up together
        text_of = "[" + ",".join("{" + ",".join(f'"{s}":{w}' for s, w in zip(names, row)) + "}" for row in per_bucket) + "]"
        weights = F.from_json(F.lit(text_of), f"array<struct<{','.join(f'{s}:bigint' for s in names)}>>")
        start = F.struct(*[F.lit(0).cast("long").alias(s) for s in names])

        def add(sums: Column, row: Column) -> Column:
            return F.struct(*[(sums[s] + row[s]).alias(s) for s in names])

        return F.aggregate(F.transform(buckets(text), lambda b: weights[b]), start, add)

    def label(self, text: Column) -> Column:
        """The language of a text; null without letters or without anything learned."""
        if not self.languages:
            return F.lit(None).cast("string")

        def best(sums: Column) -> Column:
            ranked = [F.struct(sums[f"s{i}"].alias("s"), F.lit(-i).alias("first"), F.lit(name).alias("lang")) for i, name in enumerate(self.languages)]
            return F.array_max(F.array(*ranked))["lang"]

        # a one-element array keeps the sums from being worked out once per language
        found = F.transform(F.array(self.scores(text)), best)[0]
        return F.when(text.rlike(r"\p{L}"), found)
