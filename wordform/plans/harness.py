"""Harness queries: one callable (spark, sf_dir) → DataFrame per operator.

Inputs are the supplied tables, or data Spark derives from them
(``wordform.sources.fixtures``): ``documents`` act as comments, those that the
language filter takes for German yield the stand-in lexicon and vocabulary;
``pages`` feed the clean-up functions. Every query runs over whole tables. The
stand-ins are written once per session and folder (``stand_ins``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordform import PREFIX_FILE, SUFFIX_FILE
from wordform import sinks
from wordform.functions.text import parse_context_list, sanitize_body, sanitize_text
from wordform.operators import analyze as an
from wordform.operators.corpus import duplicate_analyses, merge_increment, merge_months, review_sample, wide_contexts
from wordform.operators.filters import body_length_ok, community_filter, detect_language, lang_filter
from wordform.operators.language_model import LanguageModel, language_weights
from wordform.operators.metrics import productivity
from wordform.operators.segment import sentences, tokens
from wordform.operators.sentence_model import SentenceModel, abbreviation_scores, follower_scores, learned_abbreviations, type_counts
from wordform.operators.splits import frequency_bins, sentence_rows, shared_split, split_by_key
from wordform.operators.tokenizer import RuleTokenizer
from wordform.plans.stages import Derivatives, filter_comments, find_derivatives, make_corpora, run_corpus
from wordform.session import cut_lineage, ensure_checkpoint_dir
from wordform.sources import fixtures as fx
from wordform.sources.comments import line_status, read_comments, read_filtered_comments
from wordform.sources.dumps import scan_dumps
from wordform.sources.lexicon import read_lexicon
from wordform.sources.lists import read_affixes, read_communities, read_vocab
from wordform.streaming.increment import merged_derivatives, stream_counts

KEY = ["doc_id"]
CONTEXT_SEP = "\u241e"
SENTENCE = r"[^.!?\n]+[.!?]*"
N_PSEUDO_MONTHS = 12
FEW_ROWS = 50
SEED = 200
SAMPLE_SEED = 7


def _affixes(spark: SparkSession) -> DataFrame:
    return read_affixes(spark, PREFIX_FILE, SUFFIX_FILE)


@dataclass
class StandIns:
    """Written inputs of the derivative family, and what the analysis makes of
    them per (vocabulary on, lexicon on)."""

    german: DataFrame
    words: DataFrame
    prepared: dict[tuple[bool, bool], an.Resources]
    derived: dict[tuple, Derivatives]


_STAND_INS: dict[tuple[str, str], StandIns] = {}


def stand_ins(spark: SparkSession, sf: str) -> StandIns:
    """The German comments and their word counts, written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STAND_INS:
        german = cut_lineage(fx.german_comments(spark, sf), "german")
        _STAND_INS[key] = StandIns(german, cut_lineage(fx.word_counts(german), "word-counts"), {}, {})
    return _STAND_INS[key]


def _inputs(spark: SparkSession, sf: str, require_vocab: bool = True, lexicon: bool = True):
    """German comments and the prepared analysis inputs."""
    s = stand_ins(spark, sf)
    if (require_vocab, lexicon) not in s.prepared:
        lex = fx.fixture_lexicon(s.words) if lexicon else None
        s.prepared[require_vocab, lexicon] = an.prepare(_affixes(spark), lex, fx.fixture_vocab(s.words), require_vocab)
    return s.german, s.prepared[require_vocab, lexicon]


def _derivatives(spark: SparkSession, sf: str, require_vocab: bool = True, lexicon: bool = True, docs: DataFrame | None = None, key_cols=tuple(KEY), **kw):
    """The search over the German comments or ``docs``; queries that differ only in
    what they make of it share its written analyses."""
    german, res = _inputs(spark, sf, require_vocab, lexicon)
    known = stand_ins(spark, sf).derived
    key = (require_vocab, lexicon, *sorted(kw.items()))
    if docs is None and key in known:
        return known[key]
    found = find_derivatives(german if docs is None else docs, None, None, None, require_vocab=require_vocab, key_cols=key_cols, resources=res, **kw)
    if docs is None:
        known[key] = found
    return found


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/wordform-{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- filters ---

def q_community_filter(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", "source")
    return community_filter(docs, fx.fixture_communities(spark), col="source")


def q_sanitize_body(spark, sf):
    p = spark.read.parquet(f"{sf}/pages.parquet")
    return p.select("page_id", sanitize_body(F.col("html")).alias("body"), sanitize_body(F.col("url")).alias("url"))


def q_sanitize_text(spark, sf):
    p = spark.read.parquet(f"{sf}/pages.parquet")
    return p.select("page_id", sanitize_text(F.col("html")).alias("text"), sanitize_text(F.col("url")).alias("url"))


def q_body_length_filter(spark, sf):
    d = fx.documents(spark, sf).withColumn("clean", sanitize_body(F.col("text")))
    return d.where(body_length_ok(F.col("clean"))).select("doc_id", F.length("clean").alias("n_clean"))


def q_lang_filter(spark, sf):
    return lang_filter(fx.documents(spark, sf).select("doc_id", "lang", "text"), "text", "de").select("doc_id", "lang")


def q_language_labels(spark, sf):
    d = fx.documents(spark, sf).select("doc_id", "lang", "text")
    return detect_language(d, "text", "lang_pred").drop("text")


HELD_OUT_EVERY = 5


def _learned_from(spark, sf) -> DataFrame:
    """Documents of which language models are learned: four of five."""
    return fx.documents(spark, sf).where(F.col("doc_id") % HELD_OUT_EVERY != 0)


def q_language_weights(spark, sf):
    """The learned language model as a table."""
    return language_weights(_learned_from(spark, sf), "text", "lang")


def q_language_learned(spark, sf):
    """Every document's language by the learned model, those it has not seen marked."""
    model = LanguageModel.fit(_learned_from(spark, sf), "text", "lang")
    held_out = F.col("doc_id") % HELD_OUT_EVERY == 0
    return fx.documents(spark, sf).select("doc_id", held_out.alias("held_out"), model.label(F.col("text")).alias("lang_pred"))


def q_comment_filter(spark, sf):
    d = fx.documents(spark, sf).select("doc_id", F.col("source").alias("subreddit"), F.col("text").alias("body"))
    kept = filter_comments(d, fx.fixture_communities(spark))
    return kept.select("doc_id", "subreddit", F.length("clean_body").alias("n_clean"))


# ----------------------------------------------------------- segmentation ---

def q_sentences(spark, sf):
    s = sentences(fx.comments(spark, sf), KEY, "body", keep_all=True)
    kept = F.col("n_tokens").between(10, 100)
    return s.select("doc_id", "sent_pos", "sentence", "n_tokens", kept.alias("kept"))


def q_tokens(spark, sf):
    return tokens(sentences(fx.comments(spark, sf), KEY, "body"), KEY)


def q_abbreviation_scores(spark, sf):
    """Every word type of all documents, how often a full stop follows it, and whether it is an abbreviation."""
    return abbreviation_scores(cut_lineage(type_counts(fx.documents(spark, sf), "text"), "types"))


def q_follower_scores(spark, sf):
    """Words behind sentence ends, and behind abbreviations, initials and numbers."""
    docs = fx.documents(spark, sf)
    counts = cut_lineage(type_counts(docs, "text"), "types")
    return follower_scores(docs, "text", counts, learned_abbreviations(counts))


def q_sentences_learned(spark, sf):
    """The sentences of all documents by the model that is learned from them."""
    docs = fx.documents(spark, sf)
    model = SentenceModel.fit(docs, "text")
    return docs.select("doc_id", F.posexplode(model.split(F.col("text"))).alias("sent_pos", "sentence"))


def q_tokens_ruled(spark, sf):
    """Every document's tokens by the rule tokeniser, in order, as a number and a digest."""
    toks = RuleTokenizer().tokenize(F.col("text"))
    d = fx.documents(spark, sf).where("text is not null").select("doc_id", F.explode(F.array(toks)).alias("toks"))
    return d.select("doc_id", F.size("toks").alias("n_tokens"), F.md5(F.encode(F.array_join("toks", " "), "utf-8")).alias("tokens_md5"))


# ---------------------------------------------------------------- lexicon ---

def q_lexicon_clean(spark, sf):
    """Raw rows of every word of every document, cleaned."""
    return fx.fixture_lexicon(fx.word_counts(fx.comments(spark, sf)), 1, 1)


def _types(spark, sf):
    """Vocabulary-gated token counts and the prepared analysis inputs."""
    docs, res = _inputs(spark, sf)
    return an.gated_counts(tokens(sentences(docs, KEY, "body"), KEY), res), res


def q_vocab_gate(spark, sf):
    return _types(spark, sf)[0]


def _forced(spark, sf) -> an.Resources:
    """The analysis inputs with a dictionary that may not be broadcast."""
    s = stand_ins(spark, sf)
    if "forced" not in s.prepared:
        lex, vocab = fx.fixture_lexicon(s.words), fx.fixture_vocab(s.words)
        s.prepared["forced"] = an.prepare(_affixes(spark), lex, vocab, True, max_broadcast_rows=FEW_ROWS)
    return s.prepared["forced"]


def q_vocab_gate_bloom(spark, sf):
    """The gate when the vocabulary is beyond the broadcast bounds: tokens are
    counted, a Bloom filter lets most new words pass, the rest meet the vocabulary."""
    toks = tokens(sentences(stand_ins(spark, sf).german, KEY, "body"), KEY)
    return an.gated_counts(toks, _forced(spark, sf))


def q_analyses_bloom(spark, sf):
    """The analysis with a dictionary beyond the broadcast bounds."""
    return an.analyze(q_vocab_gate_bloom(spark, sf).select("token"), resources=_forced(spark, sf), gate=False)


def _matched(spark, sf):
    types, res = _types(spark, sf)
    return an.match_affixes(types.select("token"), res.affixes, res.max_affix_len, checked=True), res


def q_affix_match(spark, sf):
    m, _ = _matched(spark, sf)
    return m.select("token", F.array_join("prefixes", ",").alias("prefixes"), F.array_join("suffixes", ",").alias("suffixes"))


def q_candidates(spark, sf):
    m, _ = _matched(spark, sf)
    return an.candidates(m).select("token", "mode", "prefix", "suffix", "stem")


def _evaluated(spark, sf):
    m, res = _matched(spark, sf)
    return an.evaluate_candidates(an.candidates(m), res)


def q_lexicon_probe(spark, sf):
    e = _evaluated(spark, sf)
    return e.select("token", "prefix", "suffix", "stem", "in_lexica", F.col("lstem_base").alias("lex_base"), "bad_pos")


def q_prefix_elimination(spark, sf):
    e = _evaluated(spark, sf).where(F.col("prefix").isNotNull())
    return e.select("token", "prefix", "suffix", "stem", "eliminated")


def q_suffix_elimination(spark, sf):
    e = _evaluated(spark, sf).where(F.col("suffix").isNotNull())
    return e.select("token", "prefix", "suffix", "stem", "eliminated")


def q_prefix_base(spark, sf):
    e = _evaluated(spark, sf).where(F.col("mode") == "prefix")
    return e.select("token", "prefix", "stem", "rule_base")


def q_suffix_base(spark, sf):
    e = _evaluated(spark, sf).where(F.col("mode") != "prefix")
    return e.select("token", "prefix", "suffix", "stem", "rule_base")


def q_analyses(spark, sf):
    types, res = _types(spark, sf)
    return an.analyze(types.select("token"), resources=res, gate=False)


# ------------------------------------------------------------ derivatives ---

SUMMARY_COLS = ["token", "mode", "prefix", "suffix", "affix", "base", "stem", "in_lexica", "count"]


def q_derivatives(spark, sf):
    return _derivatives(spark, sf).summary.select(*SUMMARY_COLS)


def q_derivative_contexts(spark, sf):
    return _derivatives(spark, sf).long


def q_derivative_contexts_shuffled(spark, sf):
    """The same occurrences when only a few analyses may be broadcast."""
    return _derivatives(spark, sf, max_broadcast_rows=FEW_ROWS).long


def q_derivatives_no_vocab(spark, sf):
    return _derivatives(spark, sf, require_vocab=False).summary.select(*SUMMARY_COLS)


def _with_month(docs: DataFrame) -> DataFrame:
    return docs.withColumn("month", (F.col("doc_id") % N_PSEUDO_MONTHS).cast("int"))


def _monthly(spark, sf):
    known = stand_ins(spark, sf).derived
    if "monthly" not in known:
        known["monthly"] = _derivatives(spark, sf, docs=_with_month(stand_ins(spark, sf).german), group_cols=("month",))
    return known["monthly"]


def q_month_merge(spark, sf):
    return merge_months([_monthly(spark, sf).summary.drop("month")])


def q_stream_merge(spark, sf):
    """Months that arrive as files: the running counts over the first half of the year,
    and, started again, over the rest."""
    german, res = _inputs(spark, sf)
    dumps, state = _scratch(spark, "arriving"), _scratch(spark, "merge-state")
    half = N_PSEUDO_MONTHS // 2
    fx.write_dumps(spark, german, dumps, range(1, half + 1))
    stream_counts(spark, dumps, res, state, filtered=True).awaitTermination()
    fx.add_dumps(spark, dumps, range(half + 1, N_PSEUDO_MONTHS + 1))
    stream_counts(spark, dumps, res, state, filtered=True).awaitTermination()
    return merged_derivatives(spark, state, res).select(*SUMMARY_COLS)


def q_month_merge_contexts(spark, sf):
    """The merged table with the contexts of all months, in rows of few contexts."""
    w = wide_contexts(_monthly(spark, sf).long, ["month", *KEY, "sent_pos", "tok_pos"], MERGED_MAX_PER_ROW)
    return w.select(*WIDE_COLS, F.array_join("context", CONTEXT_SEP).alias("contexts"))


def q_merge_increment(spark, sf):
    m = _monthly(spark, sf).summary
    last = N_PSEUDO_MONTHS - 1
    merged = merge_months([m.where(F.col("month") < last).drop("month")])
    return merge_increment(merged, m.where(F.col("month") == last).drop("month"))


def _merged(spark, sf):
    return merge_months([_derivatives(spark, sf).summary])


def q_duplicate_analyses(spark, sf):
    a = _derivatives(spark, sf).summary
    b = _derivatives(spark, sf, lexicon=False).summary
    return duplicate_analyses(merge_months([a, b])).select(*SUMMARY_COLS)


def q_review_sample(spark, sf):
    return review_sample(_merged(spark, sf), n=100, seed=SAMPLE_SEED).select(*SUMMARY_COLS)


def q_productivity(spark, sf):
    return productivity(_merged(spark, sf))


def q_productivity_by_mode(spark, sf):
    """One mode at a time, put together."""
    merged = _merged(spark, sf)
    return productivity(merged, ["suffix"]).unionByName(productivity(merged, ["both"]))


def q_frequency_bins(spark, sf):
    """Bins of every word of every document."""
    return frequency_bins(fx.word_counts(fx.comments(spark, sf)), count_col="n")


def q_mode_split(spark, sf):
    m = _merged(spark, sf)
    return m.groupBy("mode").agg(F.count(F.lit(1)).alias("types"), F.sum("count").alias("tokens"))


# ----------------------------------------------------------------- splits ---

ROW_COLS = ["token", "doc_id", "sent_pos", "tok_pos", "mode", "bin", "base", "stem", "split"]


def _rows(spark, sf):
    r = _derivatives(spark, sf)
    # the exact split reads its rows several times: materialise them once
    return cut_lineage(sentence_rows(r.long, r.summary))


def q_shared_split(spark, sf):
    rows = _rows(spark, sf)
    return shared_split(rows, ["mode", "bin"], ["token", *KEY, "sent_pos", "tok_pos"], SEED).select(*ROW_COLS)


def q_split_by_base(spark, sf):
    return split_by_key(_rows(spark, sf), ["mode", "bin"], "base", SEED).select(*ROW_COLS)


def q_split_by_stem(spark, sf):
    return split_by_key(_rows(spark, sf), ["mode", "bin"], "stem", SEED).select(*ROW_COLS)


WIDE_MAX_PER_ROW = 10_000
MERGED_MAX_PER_ROW = 2
WIDE_COLS = ["token", "affix", "base", "in_lexica", "stem", "mode", "part", "n_parts", "count", "part_count"]


def q_derivatives_wide(spark, sf):
    """The reference's derivative table layout: one row per derivative (and
    part) with its context list, joined to one string for hashing."""
    r = _derivatives(spark, sf)
    w = wide_contexts(r.long, [*KEY, "sent_pos", "tok_pos"], WIDE_MAX_PER_ROW)
    return w.select(*WIDE_COLS, F.array_join("context", CONTEXT_SEP).alias("contexts"))


def q_corpora(spark, sf):
    """All SHARED and SPLIT corpora in one table (condition column)."""
    r = _derivatives(spark, sf)
    out = make_corpora(r.long, r.summary, key_cols=tuple(KEY), seed=SEED)
    return out.select("condition", *ROW_COLS)


CONV_KEY = ("conv_id", "turn")


def q_conversation_derivatives(spark, sf):
    """A second text source: conversation turns pass the length and language
    filter, then the derivative search keyed by (conv_id, turn); lexicon and
    vocabulary still come from the German documents."""
    conv = spark.read.parquet(f"{sf}/conversations.parquet").select(*CONV_KEY, F.col("text").alias("body"))
    kept = filter_comments(conv, None, lang="de").select(*CONV_KEY, "body")
    return _derivatives(spark, sf, docs=kept, key_cols=CONV_KEY).summary.select(*SUMMARY_COLS)


# ------------------------------------------------------- sources and sinks ---


def _dumps(spark, sf) -> str:
    return fx.write_dumps(spark, fx.comments(spark, sf), _scratch(spark, "dumps"))


def _community_file(spark) -> str:
    lines = spark.createDataFrame([(x,) for x in fx.FIXTURE_COMMUNITY_LINES], "value string")
    return fx.write_lines(lines, _scratch(spark, "communities"))


def q_comments_scan(spark, sf):
    """Monthly dumps with malformed lines, a stray file beside them."""
    c = read_comments(spark, _dumps(spark, sf))
    return c.select("id", "subreddit", F.length("body").alias("n_body"), F.md5("body").alias("body_md5"), "year", "month", "corrupt")


def q_line_status(spark, sf):
    """How many lines of each month's dumps are what; every third document's body is
    left out, every fifth's is null."""
    body = F.when(F.col("doc_id") % 3 == 0, F.lit("{}")).when(F.col("doc_id") % 5 == 0, F.lit('{"body":null}')).otherwise(F.to_json(F.struct(F.col("text").alias("body"))))
    lines = fx.documents(spark, sf).select(F.col("doc_id").alias("id"), body.alias("raw"))
    dumped = read_comments(spark, _dumps(spark, sf)).select("month", "raw")
    every = lines.select(F.lit(0).alias("month"), "raw").unionByName(dumped)
    return every.groupBy("month", line_status(F.col("raw")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


SMALL_SPLIT = 1 << 16


def q_dump_source(spark, sf):
    """The same dumps through the data source, each in several byte ranges."""
    c = scan_dumps(spark, _dumps(spark, sf), split_bytes=SMALL_SPLIT)
    return c.select("id", "subreddit", F.md5("body").alias("body_md5"), "year", "month", "corrupt")


def q_dump_source_pushed(spark, sf):
    """Two months and three communities, chosen inside the reader."""
    months = [(fx.DUMP_YEAR, 3), (fx.DUMP_YEAR, 7), (fx.DUMP_YEAR + 1, 7)]
    c = scan_dumps(spark, _dumps(spark, sf), months=months, communities=["src2", "src3", "src14", "nobody"], split_bytes=SMALL_SPLIT)
    return c.select("id", "subreddit", F.md5("body").alias("body_md5"), "month")


def q_comments_months(spark, sf):
    """Two months by number, one of which there is no dump of."""
    c = read_comments(spark, _dumps(spark, sf), months=[(fx.DUMP_YEAR, 3), (fx.DUMP_YEAR + 1, 3)])
    return c.where("not corrupt").select("id", "year", "month")


def q_filtered_roundtrip(spark, sf):
    """Dumps through the comment filter into its files and back."""
    path = _scratch(spark, "filtered")
    c = read_comments(spark, _dumps(spark, sf)).where("not corrupt")
    sinks.write_filtered_comments(filter_comments(c, read_communities(spark, _community_file(spark))), path)
    return read_filtered_comments(spark, path).select("id", F.length("body").alias("n_body"), F.md5("body").alias("body_md5"), "year", "month")


def q_community_scan(spark, sf):
    """Sources in a list file, each twice and padded, and how many documents each has."""
    d = fx.documents(spark, sf)
    lines = d.select(F.concat(F.lit(" "), "source", F.lit("\t"))).union(d.select("source"))
    names = read_communities(spark, fx.write_lines(lines, _scratch(spark, "list")))
    return d.join(names, d["source"] == names["subreddit"], "left_semi").groupBy("source").agg(F.count("*").alias("n"))


def q_vocab_scan(spark, sf):
    """Vocabulary of every document's words, each written once per document."""
    lower = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(fx.WORD_RE), 0))
    lines = fx.documents(spark, sf).select(F.explode(lower).alias("value"))
    return read_vocab(spark, fx.write_lines(lines, _scratch(spark, "vocab")))


def _lexicon_file(spark, sf) -> str:
    return fx.write_lexicon(fx.fixture_lexicon_raw(stand_ins(spark, sf).words), _scratch(spark, "lexicon"))


def q_lexicon_scan(spark, sf):
    """The stand-in lexicon from its file; the last line of a word counts."""
    return read_lexicon(spark, _lexicon_file(spark, sf))


def q_monthly_tables(spark, sf):
    """Monthly tables into their files, one month once more, and back."""
    path = _scratch(spark, "monthly")
    m = cut_lineage(_monthly(spark, sf).summary.withColumn("year", F.lit(fx.DUMP_YEAR)))
    sinks.write_derivatives(m, path)
    sinks.write_derivatives(m.where("month = 3"), path)
    return spark.read.parquet(path).select("year", "month", *SUMMARY_COLS)


def q_joined_table(spark, sf):
    """The merged table written twice, the second time as it is to stay."""
    path = _scratch(spark, "joined")
    m = cut_lineage(_merged(spark, sf))
    sinks.write_joined(m.withColumn("count", F.col("count") + 1), path)
    sinks.write_joined(m, path)
    return spark.read.parquet(path).select(*SUMMARY_COLS)


def q_corpora_roundtrip(spark, sf):
    """All corpora, then those of one condition in their place, re-read."""
    path = _scratch(spark, "corpora")
    r = _derivatives(spark, sf)
    out = cut_lineage(make_corpora(r.long, r.summary, key_cols=tuple(KEY), seed=SEED))
    sinks.write_corpora(out, path)
    sinks.write_corpora(out.where("condition = 'split_base'"), path)
    return spark.read.parquet(path).select("condition", *ROW_COLS)


def q_shared_roundtrip(spark, sf):
    """The SHARED corpora written over all corpora, re-read."""
    path = _scratch(spark, "shared")
    r = _derivatives(spark, sf)
    out = cut_lineage(make_corpora(r.long, r.summary, key_cols=tuple(KEY), seed=SEED))
    sinks.write_corpora(out, path)
    sinks.write_corpora(out.where("condition = 'shared'"), path)
    return spark.read.parquet(path).select("condition", *ROW_COLS)


def q_productivity_roundtrip(spark, sf):
    """Both modes' files, then one mode in their place, re-read."""
    path = _scratch(spark, "productivity")
    m = cut_lineage(productivity(_merged(spark, sf)))
    sinks.write_productivity(m, path)
    sinks.write_productivity(m.where("mode = 'suffix'"), path)
    return spark.read.option("header", True).schema("affix string, v long, n long, abshapax long, mode string").csv(path)


def q_corpus_run(spark, sf):
    """Every stage from dumps to corpora; the joined table."""
    vocab = fx.write_lines(fx.fixture_vocab(stand_ins(spark, sf).words), _scratch(spark, "vocab"))
    out = _scratch(spark, "run")
    run_corpus(spark, _dumps(spark, sf), _community_file(spark), PREFIX_FILE, SUFFIX_FILE, _lexicon_file(spark, sf), vocab, out)
    return spark.read.parquet(f"{out}/joined").select(*SUMMARY_COLS)


def q_context_list_import(spark, sf):
    """Each document's sentences as a printed list, twice in a row as a merge of
    months leaves them, read back."""
    s = F.regexp_extract_all(F.replace(F.replace("text", F.lit("'"), F.lit("")), F.lit("\\"), F.lit("")), F.lit(SENTENCE), 0)
    printed = F.concat(F.lit("['"), F.array_join(s, "', '"), F.lit("']"))
    d = fx.documents(spark, sf).select("doc_id", F.concat(printed, printed).alias("printed"))
    return d.select("doc_id", F.array_join(parse_context_list("printed"), CONTEXT_SEP).alias("contexts"))


QUERIES = {
    "community_filter": q_community_filter,
    "sanitize_body": q_sanitize_body,
    "sanitize_text": q_sanitize_text,
    "body_length_filter": q_body_length_filter,
    "lang_filter": q_lang_filter,
    "language_labels": q_language_labels,
    "language_weights": q_language_weights,
    "language_learned": q_language_learned,
    "comment_filter": q_comment_filter,
    "sentences": q_sentences,
    "tokens": q_tokens,
    "abbreviation_scores": q_abbreviation_scores,
    "follower_scores": q_follower_scores,
    "sentences_learned": q_sentences_learned,
    "tokens_ruled": q_tokens_ruled,
    "lexicon_clean": q_lexicon_clean,
    "vocab_gate": q_vocab_gate,
    "vocab_gate_bloom": q_vocab_gate_bloom,
    "analyses_bloom": q_analyses_bloom,
    "affix_match": q_affix_match,
    "candidates": q_candidates,
    "lexicon_probe": q_lexicon_probe,
    "prefix_elimination": q_prefix_elimination,
    "suffix_elimination": q_suffix_elimination,
    "prefix_base": q_prefix_base,
    "suffix_base": q_suffix_base,
    "analyses": q_analyses,
    "derivatives": q_derivatives,
    "derivative_contexts": q_derivative_contexts,
    "derivative_contexts_shuffled": q_derivative_contexts_shuffled,
    "derivatives_no_vocab": q_derivatives_no_vocab,
    "month_merge": q_month_merge,
    "stream_merge": q_stream_merge,
    "month_merge_contexts": q_month_merge_contexts,
    "merge_increment": q_merge_increment,
    "duplicate_analyses": q_duplicate_analyses,
    "review_sample": q_review_sample,
    "productivity": q_productivity,
    "productivity_by_mode": q_productivity_by_mode,
    "frequency_bins": q_frequency_bins,
    "mode_split": q_mode_split,
    "shared_split": q_shared_split,
    "split_by_base": q_split_by_base,
    "split_by_stem": q_split_by_stem,
    "derivatives_wide": q_derivatives_wide,
    "corpora": q_corpora,
    "conversation_derivatives": q_conversation_derivatives,
    "comments_scan": q_comments_scan,
    "line_status": q_line_status,
    "dump_source": q_dump_source,
    "dump_source_pushed": q_dump_source_pushed,
    "comments_months": q_comments_months,
    "filtered_roundtrip": q_filtered_roundtrip,
    "community_scan": q_community_scan,
    "vocab_scan": q_vocab_scan,
    "lexicon_scan": q_lexicon_scan,
    "monthly_tables": q_monthly_tables,
    "joined_table": q_joined_table,
    "corpora_roundtrip": q_corpora_roundtrip,
    "shared_roundtrip": q_shared_roundtrip,
    "productivity_roundtrip": q_productivity_roundtrip,
    "corpus_run": q_corpus_run,
    "context_list_import": q_context_list_import,
}
