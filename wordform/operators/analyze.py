"""Derivative analysis of word types.

The analysis depends only on the token (given affixes, lexicon and
vocabulary), so it runs once per distinct token, never per occurrence:

    types ──▷ vocab (anti) ──⋈ affixes (substring equi-join) ──► candidates
          ──⋈ dictionary on lower(stem), on the probe key, on lower(rule base)
          ──► rule columns ──► survivors ──► best candidate per token

The dictionary is broadcast behind a check of its rows and bytes; probes share
the exchange. The joins keep the token partitioning of ``types``, so
the final per-token choice needs no extra exchange when ``types`` comes out of
a ``groupBy('token')``. A dictionary beyond the bounds stays where it is: a Bloom
filter (``operators.bloom``) tells which keys can be in it, and only those, once per
token, are joined with it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordform.functions import rules
from wordform.operators.bloom import BloomFilter
from wordform.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, bounded_broadcast
from wordform.session import cut_lineage

ANALYSIS_COLS = ["token", "mode", "prefix", "suffix", "affix", "base", "stem", "in_lexica"]


def build_dictionary(lexicon: DataFrame | None, vocab: DataFrame | None) -> DataFrame:
    """One row per lower-case key with lexicon and vocabulary facts:
    key, in_lexicon, lex_base, lex_pos, base_in_vocab, in_vocab.

    ``lexicon`` is the cleaned lexicon (word, base, pos, frequency) with
    lower-case unique words; ``vocab`` is DataFrame(token).
    """
    spark = (lexicon if lexicon is not None else vocab).sparkSession
    if lexicon is None:
        lexicon = spark.createDataFrame([], "word string, base string, pos string, frequency double")
    lex = lexicon.select(F.col("word").alias("key"), F.col("base").alias("lex_base"), F.col("pos").alias("lex_pos"))
    if vocab is None:
        return lex.select(
            "key", F.lit(True).alias("in_lexicon"), "lex_base", "lex_pos",
            F.lit(False).alias("base_in_vocab"), F.lit(False).alias("in_vocab"),
        )
    v = vocab.select(F.col("token").alias("vkey")).distinct()
    lex = lex.join(v.withColumnRenamed("vkey", "bkey"), F.lower(F.col("lex_base")) == F.col("bkey"), "left").select(
        "key", "lex_base", "lex_pos", F.col("bkey").isNotNull().alias("base_in_vocab")
    )
    d = lex.join(v, lex["key"] == v["vkey"], "full_outer")
    return d.select(
        F.coalesce("key", "vkey").alias("key"),
        F.col("key").isNotNull().alias("in_lexicon"),
        "lex_base",
        "lex_pos",
        F.coalesce("base_in_vocab", F.lit(False)).alias("base_in_vocab"),
        F.col("vkey").isNotNull().alias("in_vocab"),
    )


def max_affix_length(affixes: DataFrame) -> int:
    """Longest affix; a single scalar aggregated by Spark."""
    v = affixes.agg(F.max(F.length("affix"))).first()[0]
    return int(v or 0)


class Resources(NamedTuple):
    """Small inputs of the analysis, prepared once per run: materialised in
    the checkpoint folder, size-checked, broadcast-hinted when small."""

    affixes: DataFrame
    max_affix_len: int
    dictionary: DataFrame
    require_vocab: bool
    #: Filters of the keys and of the vocabulary's, for a dictionary that isn't broadcast.
    known: BloomFilter | None = None
    vocab_known: BloomFilter | None = None


def prepare(
    affixes: DataFrame,
    lexicon: DataFrame | None,
    vocab: DataFrame | None,
    require_vocab: bool = True,
    materialize: bool = True,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> Resources:
    """Build the dictionary, write it and the affix list to the checkpoint
    folder (``materialize``), measure both and hint them for broadcast within
    ``max_broadcast_rows``; a larger dictionary gets Bloom filters."""
    if require_vocab and vocab is None:
        raise ValueError("require_vocab=True needs a vocabulary")
    aff = affixes.select("affix", "kind")
    dictionary = build_dictionary(lexicon, vocab if require_vocab else None)
    if materialize:
        aff = cut_lineage(aff)
        dictionary = cut_lineage(dictionary)
    # one job gives the size check and the longest affix
    n_aff, max_len = aff.agg(F.count(F.lit(1)), F.max(F.length("affix"))).first()
    if n_aff <= max_broadcast_rows:
        aff = F.broadcast(aff)
    d, small = bounded_broadcast(dictionary, max_broadcast_rows)
    if small:
        return Resources(aff, int(max_len or 0), d, require_vocab)
    n, n_vocab = dictionary.agg(F.count(F.lit(1)), F.count_if(F.col("in_vocab"))).first()
    known = BloomFilter.of(dictionary.select("key"), n)
    vocab_known = BloomFilter.of(dictionary.where("in_vocab").select("key"), n_vocab) if require_vocab else None
    return Resources(aff, int(max_len or 0), d, require_vocab, known, vocab_known)


#: What a dictionary row says, as one array: every join takes the same two columns,
#: so that Spark can reuse one broadcast for several of them.
FACTS = {"in_lexicon": 0, "lex_base": 1, "lex_pos": 2, "base_in_vocab": 3, "in_vocab": 4}


def _facts(dictionary: DataFrame, key: str, out: str) -> DataFrame:
    each = [F.when(F.col(c), F.lit("1")) if c not in ("lex_base", "lex_pos") else F.col(c) for c in FACTS]
    return dictionary.select(F.col("key").alias(key), F.array(*each).alias(out))


def _fact(facts: str, name: str) -> Column:
    value = F.get(F.col(facts), F.lit(FACTS[name]))
    return value if name in ("lex_base", "lex_pos") else value.isNotNull()


def looked_up(df: DataFrame, keys: dict[str, Column], res: Resources) -> DataFrame:
    """``df`` (with ``token``) with the dictionary's facts of each key: columns
    named as in ``keys``, null where the key isn't in the dictionary.

    Within the broadcast bounds each key is a hash join with a broadcast table.
    Beyond them the keys of all rows of a token that the Bloom filter lets through
    are joined in one go, distinct, and come back as a map per token: what moves
    are those keys and the rows of one join by token."""
    if res.known is None:
        for name, key in keys.items():
            df = df.join(_facts(res.dictionary, "_key", name), key == F.col("_key"), "left").drop("_key")
        return df
    each = df.select("token", F.explode(F.array_distinct(F.array(*keys.values()))).alias("_key")).where("_key is not null").distinct()
    asked = res.known.probed(each, F.col("_key")).where("may_be_in").drop("may_be_in")
    found = asked.join(_facts(res.dictionary, "_d_key", "_facts"), F.col("_key") == F.col("_d_key"))
    # a token has a handful of keys
    found = found.groupBy(F.col("token").alias("_token")).agg(F.map_from_entries(F.collect_list(F.struct("_key", "_facts"))).alias("_found"))
    df = df.join(found, F.col("token") == F.col("_token"), "left")
    return df.select("*", *[F.try_element_at("_found", key).alias(name) for name, key in keys.items()]).drop("_token", "_found")


def gated(toks: DataFrame, res: Resources) -> DataFrame:
    """Rows whose token is not a vocabulary word (all without a vocabulary).

    Within the broadcast bounds a row-local probe. Beyond them only rows that the
    Bloom filter takes for vocabulary words meet the vocabulary itself; pass
    counted tokens then (``gated_counts``)."""
    if not res.require_vocab:
        return toks
    word = F.lower(F.col("token"))
    if res.vocab_known is None:
        return toks.join(_facts(res.dictionary, "_key", "_facts"), word == F.col("_key"), "left").where(
            ~F.coalesce(_fact("_facts", "in_vocab"), F.lit(False))
        ).drop("_key", "_facts")
    probed = res.vocab_known.probed(toks, word, "_may")
    voc = res.dictionary.where("in_vocab").select(F.col("key").alias("_key"))
    asked = probed.where("_may").join(voc, word == F.col("_key"), "left_anti")
    return probed.where("not _may").unionByName(asked).drop("_may")


def gated_counts(toks: DataFrame, res: Resources, group_cols: list[str] | None = None) -> DataFrame:
    """Counts of the tokens that are not vocabulary words, per group. A vocabulary
    that is broadcast is probed before the count, so its words are never
    counted; a larger one after it, so that only distinct tokens move."""
    keys = [*(group_cols or []), "token"]
    first = res.vocab_known is None
    counts = (gated(toks, res) if first else toks).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return counts if first else gated(cut_lineage(counts, "all-counts"), res)


def match_affixes(types: DataFrame, affixes: DataFrame, max_len: int | None = None,
                  max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, checked: bool = False,
                  carry: list[str] | None = None) -> DataFrame:
    """Per token: ``prefixes`` / ``suffixes`` arrays of the affixes that the
    lower-cased token starts / ends with. Tokens without a match are dropped.

    Every leading and trailing substring up to the longest affix is
    equi-joined with the (broadcast) affix table: no per-row loop over the
    list and no theta join.
    """
    if max_len is None:
        max_len = max_affix_length(affixes)
    aff = affixes.select("affix", "kind")
    if not checked:
        aff, _ = bounded_broadcast(aff, max_broadcast_rows)
    carry = carry or []
    lw = F.lower(F.col("token"))
    # explode k = 1..min(len, longest affix), then both pieces per k: plain
    # generators and projections, all inside whole-stage codegen
    ks = types.where(F.length("token") >= 1).select(
        "token", *carry, lw.alias("lw"), F.explode(F.sequence(F.lit(1), F.least(F.length(lw), F.lit(max(max_len, 1))))).alias("k")
    )
    exploded = ks.select(
        "token", *carry,
        F.explode(
            F.array(
                F.struct(F.lit("prefix").alias("kind"), F.substring(F.col("lw"), F.lit(1), F.col("k")).alias("piece")),
                F.struct(F.lit("suffix").alias("kind"), F.substring(F.col("lw"), -F.col("k"), F.col("k")).alias("piece")),
            )
        ).alias("p"),
    ).select("token", *carry, F.col("p.kind").alias("kind"), F.col("p.piece").alias("piece"))
    hits = exploded.join(aff, (exploded["kind"] == aff["kind"]) & (exploded["piece"] == aff["affix"]), "inner").select(
        "token", *carry, exploded["kind"], "affix"
    )
    # carried columns depend on the token only: extra group keys, no exchange
    return hits.groupBy("token", *carry).agg(
        F.array_sort(F.collect_set(F.when(F.col("kind") == "prefix", F.col("affix")))).alias("prefixes"),
        F.array_sort(F.collect_set(F.when(F.col("kind") == "suffix", F.col("affix")))).alias("suffixes"),
    )


def candidates(matched: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Candidate readings per token, with the order key of the choice rule.

    mode = prefix if no suffix matched, suffix if no prefix matched, else
    both (every prefix × suffix pair). Order: prefixes longest first,
    suffixes shortest first.
    """
    P, S = F.col("prefixes"), F.col("suffixes")
    mode = F.when(F.size(S) == 0, "prefix").when(F.size(P) == 0, "suffix").otherwise("both")
    null = F.lit(None).cast("string")
    pairs = (
        F.when(F.size(S) == 0, F.transform(P, lambda p: F.struct(p.alias("prefix"), null.alias("suffix"))))
        .when(F.size(P) == 0, F.transform(S, lambda s: F.struct(null.alias("prefix"), s.alias("suffix"))))
        .otherwise(
            F.flatten(F.transform(P, lambda p: F.transform(S, lambda s: F.struct(p.alias("prefix"), s.alias("suffix")))))
        )
    )
    ier_er = (F.size(P) == 0) & F.array_contains(S, "ier") & F.array_contains(S, "er")
    carry = carry or []
    c = matched.select("token", *carry, mode.alias("mode"), ier_er.alias("ier_er"), F.explode(pairs).alias("c"))
    lp = F.coalesce(F.length("c.prefix"), F.lit(0))
    ls = F.coalesce(F.length("c.suffix"), F.lit(0))
    stem = F.col("token").substr(lp + 1, F.greatest(F.length("token") - lp - ls, F.lit(0)))
    return c.select(
        "token", *carry, "mode", "ier_er",
        F.col("c.prefix").alias("prefix"), F.col("c.suffix").alias("suffix"),
        (-lp).alias("ord_p"), ls.alias("ord_s"), stem.alias("stem"),
    )


def render_affix(mode, prefix, suffix):
    """The affix as one string; a prefix+suffix pair prints as a tuple."""
    return (
        F.when(mode == "prefix", prefix)
        .when(mode == "suffix", suffix)
        .otherwise(F.concat(F.lit("('"), prefix, F.lit("', '"), suffix, F.lit("')")))
    )


def evaluate_candidates(cands: DataFrame, res: Resources, carry: list[str] | None = None) -> DataFrame:
    """Apply stem length, function-word, elimination, lexicon and base rules
    to every candidate; adds in_lexica, r_base, r_stem and ``survives``."""
    require_vocab = res.require_vocab
    c = cands.where(F.length("stem") > 3)
    c = c.withColumn("lstem", F.lower("stem")).withColumn("pkey", rules.probe_key(F.col("suffix"), F.col("stem")))
    c = looked_up(c, {"f_token": F.col("token"), "f_stem": F.col("lstem"), "f_probe": F.col("pkey")}, res)
    in_lexicon = lambda f: F.coalesce(_fact(f, "in_lexicon"), F.lit(False))
    c = c.select(
        "*",
        F.when(in_lexicon("f_token"), _fact("f_token", "lex_pos")).alias("token_pos"),
        in_lexicon("f_stem").alias("lstem_in_lexicon"),
        _fact("f_stem", "lex_base").alias("lstem_base"),
        F.when(in_lexicon("f_stem"), _fact("f_stem", "lex_pos")).alias("lstem_pos"),
        _fact("f_stem", "base_in_vocab").alias("lstem_base_in_vocab"),
        F.coalesce(_fact("f_stem", "in_vocab"), F.lit(False)).alias("stem_in_vocab"),
        in_lexicon("f_probe").alias("probe_hit"),
        F.when(in_lexicon("f_probe"), _fact("f_probe", "lex_base")).alias("probe_base"),
    )

    lstem_in_lex = F.col("lstem_in_lexicon")
    # raw-case lexicon probe of the stem: keys are lower case, so a raw hit
    # means the stem is itself lower case and its lower-case probe hit
    stem_pos_raw = F.when(F.col("stem") == F.col("lstem"), F.col("lstem_pos"))
    bad_pos = F.coalesce(F.col("token_pos").isin(rules.BAD_POS), F.lit(False)) | F.coalesce(
        stem_pos_raw.isin(rules.BAD_POS), F.lit(False)
    )
    has_p, has_s = F.col("prefix").isNotNull(), F.col("suffix").isNotNull()
    eliminated = (has_p & rules.prefix_eliminated(F.col("prefix"), F.col("stem"), F.col("token"))) | (
        has_s
        & rules.suffix_eliminated(
            F.col("suffix"), F.col("stem"), F.col("token"), F.col("lstem_pos"), lstem_in_lex, F.col("probe_hit")
        )
    )
    if require_vocab:
        in_lexica = lstem_in_lex & F.coalesce(F.col("lstem_base_in_vocab"), F.lit(False))
    else:
        in_lexica = lstem_in_lex
    rb_suffix = rules.suffix_rule_base(F.col("suffix"), F.col("stem"), F.col("probe_hit"), F.col("probe_base"))
    rule_base = F.when(F.col("mode") == "prefix", rules.prefix_rule_base(F.col("prefix"), F.col("stem"), F.col("token"))).otherwise(
        F.when(rb_suffix.getField("found"), rb_suffix.getField("base"))
    )
    carry = carry or []
    c = c.select(
        "token", *carry, "mode", "ier_er", "prefix", "suffix", "ord_p", "ord_s", "stem", "lstem_base",
        "stem_in_vocab", bad_pos.alias("bad_pos"), eliminated.alias("eliminated"), in_lexica.alias("in_lexica"),
        rule_base.alias("rule_base"),
    )
    c = looked_up(c, {"f_base": F.lower(F.col("rule_base"))}, res)
    c = c.withColumn("rule_base_in_vocab", F.coalesce(_fact("f_base", "in_vocab"), F.lit(False))).drop("f_base")

    vocab_ok = (lambda col: col) if require_vocab else (lambda col: F.lit(True))
    use_lexicon_base = F.col("in_lexica") & (
        (F.col("mode") == "prefix") | ~F.col("suffix").isin(rules.SUFFIX_NO_LEXICON_BASE)
    )
    min_rule_len = F.when(F.col("mode") == "prefix", 4).when(F.col("mode") == "suffix", 3).otherwise(0)
    r_base = F.when(use_lexicon_base, F.col("lstem_base")).when(
        F.col("rule_base").isNotNull() & vocab_ok(F.col("rule_base_in_vocab")) & (F.length("rule_base") >= min_rule_len),
        F.col("rule_base"),
    )
    r_stem = F.when(vocab_ok(F.col("stem_in_vocab")), F.col("stem"))
    c = c.withColumn("r_base", r_base).withColumn("r_stem", r_stem)
    survives = ~F.col("bad_pos") & ~F.col("eliminated") & (F.col("r_base").isNotNull() | F.col("r_stem").isNotNull())
    return c.withColumn("survives", survives)


def choose(evaluated: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Best surviving reading per token: the first with ``in_lexica``;
    otherwise the second if the first two are prefixes ``erz`` then ``er``,
    or if suffixes ``ier`` and ``er`` both matched and two readings survive;
    otherwise the first. The per-token arrays hold a handful of readings."""
    carry = carry or []
    surv = evaluated.where("survives").select(
        "token", *carry, "ier_er",
        F.struct(
            "ord_p", "ord_s", "mode", "prefix", "suffix",
            F.col("r_base").alias("base"), F.col("r_stem").alias("stem"), "in_lexica",
        ).alias("c"),
    )
    g = surv.groupBy("token", *carry, "ier_er").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    first = F.try_element_at("cs", F.lit(1))
    second = F.try_element_at("cs", F.lit(2))
    first_lex = F.try_element_at(F.filter("cs", lambda x: x["in_lexica"]), F.lit(1))
    erz_er = (first["mode"] == "prefix") & (first["prefix"] == "erz") & (second["prefix"] == "er")
    take_second = (F.size("cs") >= 2) & (F.coalesce(erz_er, F.lit(False)) | F.col("ier_er"))
    pick = F.coalesce(first_lex, F.when(take_second, second), first)
    out = g.select("token", *carry, pick.alias("a"))
    return out.select(
        "token",
        F.col("a.mode").alias("mode"),
        F.col("a.prefix").alias("prefix"),
        F.col("a.suffix").alias("suffix"),
        render_affix(F.col("a.mode"), F.col("a.prefix"), F.col("a.suffix")).alias("affix"),
        F.col("a.base").alias("base"),
        F.col("a.stem").alias("stem"),
        F.col("a.in_lexica").alias("in_lexica"),
        *carry,
    )


def analyze(
    types: DataFrame,
    affixes: DataFrame | None = None,
    lexicon: DataFrame | None = None,
    vocab: DataFrame | None = None,
    require_vocab: bool = True,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    resources: Resources | None = None,
    gate: bool = True,
) -> DataFrame:
    """Analyse distinct tokens. ``types`` needs a ``token`` column and may
    carry more columns that depend on the token only (e.g. a count); they
    ride along as extra group keys, so no join back is needed.

    Pass either the raw inputs (affixes, lexicon, vocab) or ``resources``
    from ``prepare``. With ``require_vocab=False`` every vocabulary test
    passes (the documented "derivatives only" mode). ``gate=False``: the
    types hold no vocabulary words any more.
    """
    if resources is None:
        resources = prepare(affixes, lexicon, vocab, require_vocab, materialize=False,
                            max_broadcast_rows=max_broadcast_rows)
    t = gated(types, resources) if gate else types
    extra = [c for c in types.columns if c != "token"]
    matched = match_affixes(t, resources.affixes, resources.max_affix_len, checked=True, carry=extra)
    ev = evaluate_candidates(candidates(matched, extra), resources, extra)
    return choose(ev, extra)
