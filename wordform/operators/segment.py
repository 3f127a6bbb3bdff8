"""Sentence split, tokenisation and the sentence / token filters.

Default segmentation is two regular expressions evaluated JVM-side; a user
model can replace either one through a ``pandas_udf`` that returns
``array<string>`` (see ``split_sentences`` / ``tokenize``). Boundaries differ
from a statistical NLP model, so counts depend on that choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordform.functions.predicates import has_digit
from wordform.functions.text import strip_ws

# Fixed patterns: a sentence is a run without . ! ? or line break plus its
# closing marks; a token is a letter/number run or one other non-space char.
SENTENCE_RE = r"[^.!?\n]+[.!?]*"
TOKEN_RE = r"[\p{L}\p{N}]+|[^\t-\r\x1c-\x20\x{85}\p{Z}\p{L}\p{N}]"

# Sentence length bounds (tokens, punctuation included) and the
# minimum token length for a derivative candidate.
MIN_SENT_TOKENS = 10
MAX_SENT_TOKENS = 100
MIN_TOKEN_CHARS = 5


def split_sentences(text: Column, model=None) -> Column:
    """array<string> of sentences; ``model`` is an optional user pandas_udf."""
    if model is not None:
        return model(text)
    return F.regexp_extract_all(text, F.lit(SENTENCE_RE), 0)


def tokenize(sentence: Column, model=None) -> Column:
    if model is not None:
        return model(sentence)
    return F.regexp_extract_all(sentence, F.lit(TOKEN_RE), 0)


def sentences(
    docs: DataFrame,
    key_cols: list[str],
    text: str = "body",
    keep_all: bool = False,
    sentence_model=None,
    token_model=None,
) -> DataFrame:
    """One row per sentence: key_cols, sent_pos, sentence, tokens, n_tokens.

    The text is stripped first, each sentence is stripped; only sentences
    with 10..100 tokens are kept unless ``keep_all``.
    """
    stripped = F.transform(split_sentences(strip_ws(F.col(text)), sentence_model), lambda x: strip_ws(x))
    if token_model is None:
        # tokens come out of the generator, so the length filter below reads
        # them instead of re-running the tokeniser (Catalyst would otherwise
        # inline the regex into the pushed-down filter several times)
        items = F.transform(stripped, lambda x: F.struct(x.alias("sentence"), tokenize(x).alias("tokens")))
        s = docs.select(*key_cols, F.posexplode(items).alias("sent_pos", "item"))
        s = s.select(*key_cols, "sent_pos", F.col("item.sentence").alias("sentence"), F.col("item.tokens").alias("tokens"))
    else:
        s = docs.select(*key_cols, F.posexplode(stripped).alias("sent_pos", "sentence"))
        s = s.withColumn("tokens", tokenize(F.col("sentence"), token_model))
    s = s.withColumn("n_tokens", F.size("tokens"))
    if not keep_all:
        s = s.where(F.col("n_tokens").between(MIN_SENT_TOKENS, MAX_SENT_TOKENS))
    return s


def candidate_token_filter(token: Column) -> Column:
    """More than 4 characters and no decimal digit."""
    return (F.length(token) >= MIN_TOKEN_CHARS) & ~has_digit(token)


def tokens(sents: DataFrame, key_cols: list[str], carry: list[str] | None = None, filtered: bool = True) -> DataFrame:
    """One row per token: key_cols, sent_pos, tok_pos, token (+ carried
    columns). The first token of a sentence is lower-cased."""
    carry = carry or []
    t = sents.select(*key_cols, "sent_pos", *carry, F.posexplode("tokens").alias("tok_pos", "raw_token"))
    t = t.withColumn(
        "token", F.when(F.col("tok_pos") == 0, F.lower("raw_token")).otherwise(F.col("raw_token"))
    ).drop("raw_token")
    if filtered:
        t = t.where(candidate_token_filter(F.col("token")))
    return t
