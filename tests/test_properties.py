"""Property tests: re-assembly, vocabulary exclusion, merge of
months = one run, independence from partitioning, disjoint complete splits."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wordform.operators import analyze as an
from wordform.plans import harness as H
from wordform.plans.stages import find_derivatives
from wordform.sources import fixtures as fx

COLS = ["token", "mode", "prefix", "suffix", "affix", "base", "stem", "in_lexica", "count"]


def _rows(df):
    return sorted(map(repr, df.select(*COLS).collect()))


def _check_reassembly(rows):
    for r in rows:
        low = r.token.lower()
        if r.prefix:
            assert low.startswith(r.prefix)
        if r.suffix:
            assert low.endswith(r.suffix)
        if r.stem is not None:
            lp = len(r.prefix or "")
            ls = len(r.suffix or "")
            assert r.token[lp:len(r.token) - ls] == r.stem
            assert len(r.stem) > 3
        assert r.base is not None or r.stem is not None


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(keep=st.integers(min_value=1, max_value=4), seed=st.integers(min_value=0, max_value=10_000))
def test_analysis_invariants_for_random_vocabularies(spark, affixes, keep, seed):
    """Any vocabulary: stems re-assemble the token, and no token whose lower
    case is in the vocabulary is ever a derivative."""
    docs = fx.german_comments(spark, SF_SMALL)
    words = fx.word_counts(docs)
    vocab = fx.fixture_vocab(words).where(F.abs(F.xxhash64("token", F.lit(seed))) % 5 < keep)
    lex = fx.fixture_lexicon(words)
    res = find_derivatives(docs, affixes, lex, vocab, materialize=False)
    rows = res.summary.collect()
    _check_reassembly(rows)
    in_vocab = {r.token for r in vocab.collect()}
    assert not [r.token for r in rows if r.token.lower() in in_vocab]


def test_month_merge_equals_single_run(spark):
    single = H.q_derivatives(spark, SF_SMALL)
    merged = H.q_month_merge(spark, SF_SMALL)
    assert _rows(single) == _rows(merged)


def test_independent_of_partitioning_and_order(spark, affixes):
    docs = fx.german_comments(spark, SF_SMALL)
    words = fx.word_counts(docs)
    lex, voc = fx.fixture_lexicon(words), fx.fixture_vocab(words)
    a = find_derivatives(docs, affixes, lex, voc).summary
    shuffled = docs.repartition(7, F.xxhash64("doc_id")).sortWithinPartitions(F.desc("doc_id"))
    b = find_derivatives(shuffled, affixes, lex, voc).summary
    assert _rows(a) == _rows(b)


def test_no_vocab_mode_is_a_superset(spark):
    with_vocab = {r.token for r in H.q_derivatives(spark, SF_SMALL).collect()}
    without = H.q_derivatives_no_vocab(spark, SF_SMALL).collect()
    _check_reassembly(without)
    # every derivative found with the vocabulary is a candidate without it
    assert with_vocab <= {r.token for r in without}


def test_splits_disjoint_and_complete(spark):
    shared = H.q_shared_split(spark, SF_SMALL)
    rows = H._rows(spark, SF_SMALL)
    assert shared.count() == rows.count()
    dup = shared.groupBy("token", "doc_id", "sent_pos", "tok_pos", "mode", "bin").count().where("count > 1").count()
    assert dup == 0
    by_stem = H.q_split_by_stem(spark, SF_SMALL)
    assert by_stem.count() == rows.where(F.col("stem").isNotNull()).count()
    crossing = by_stem.groupBy("mode", "bin", "stem").agg(F.countDistinct("split").alias("k")).where("k > 1").count()
    assert crossing == 0


def test_dictionary_has_one_row_per_key(spark):
    words = fx.word_counts(fx.german_comments(spark, SF_SMALL))
    d = an.build_dictionary(fx.fixture_lexicon(words), fx.fixture_vocab(words))
    assert d.count() == d.select("key").distinct().count()
