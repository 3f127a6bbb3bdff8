"""Word-formation rules as pure Column expressions.

Each function maps candidate columns (token, affix, stem and lexicon probe
results) to a boolean or to a (found, base) pair. Nothing here touches a
DataFrame, so the rules compile into the same codegen stage as the joins that
feed them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordform.functions.predicates import (
    all_consonants,
    char_is_consonant,
    drop_last,
    last_char,
    starts_lower,
    starts_upper,
    title_word,
)

# ---------------------------------------------------------------------------
# These lists must stay exactly as they are for the analysis to
# give the expected results.
# ---------------------------------------------------------------------------

# POS tags of function words; a stem or token with one of them is no derivative.
BAD_POS = ["ART", "PPER", "PRF", "PIS", "PIAT", "PPOSS", "PRELS", "PRELAT", "KOUS", "KON", "KOKOM"]

# POS tags accepted for the adjective reading of suffix "e".
ADJ_POS = ["ADJA", "ADJD"]

# Prefixes that are dropped when the token starts with an upper-case letter.
PREFIX_DROP_IF_UPPER = ["ab", "ent", "er", "be"]

# Suffixes that are dropped when the token starts with a lower-case letter.
SUFFIX_DROP_IF_LOWER = ["er", "ast", "at", "i", "ie", "ier", "ik", "ine", "ist", "ling", "ner", "or", "ade", "ler", "ur"]

# Suffixes that are dropped when the token starts with an upper-case letter.
SUFFIX_DROP_IF_UPPER = ["ern", "weg", "bar", "fach", "haft", "end", "ens", "ig", "lings", "nd", "weise", "wegen"]

# Suffixes that are dropped when the stem does not end in a consonant.
SUFFIX_NEED_CONSONANT = ["i", "ie", "ik", "in", "ine", "ade"]

# Prefixes for which no base is recovered by rule.
PREFIX_NO_BASE = ["hyper", "ko", "kon", "konter", "makro", "mikro", "neo", "para", "post", "prä", "re", "retro",
                  "sub", "trans", "über", "un", "unter", "wider"]

# Prefixes whose base is a verb form ending in -en/-ern.
PREFIX_VERBAL = ["er", "ent", "ab", "be", "an", "de", "hinter", "miss", "um", "ver", "zer"]

# Prefixes whose base drops a final -e/-en or keeps -ion/-nal.
PREFIX_LATINATE = ["erz", "ex", "inter", "in", "im", "il", "multi", "ultra"]

# Suffixes that mark a confix: no base by rule.
SUFFIX_CONFIX = ["abel", "age", "al", "ant", "anz", "ar", "ast", "at", "el", "ent", "ibel", "ie", "ik"]

# Suffixes whose base is the stem itself.
SUFFIX_BASE_IS_STEM = ["alie", "chen", "ei", "schaft", "tum", "in", "keit", "mäßig", "nis"]

# Suffix whose lexicon base is not used even when the stem is in the lexicon.
SUFFIX_NO_LEXICON_BASE = ["end"]

# Second lexicon probe: the suffix and the string appended to the raw stem.
PROBE_SUFFIX = {"ig": "e", "isch": "e", "ner": "en", "ette": "et"}


def _in(c: Column, values: list[str]) -> Column:
    return c.isin(values)


def prefix_eliminated(prefix: Column, stem: Column, token: Column) -> Column:
    """True if a prefix reading must be discarded."""
    return (
        ((prefix == "a") & stem.startswith("b"))
        | (_in(prefix, PREFIX_DROP_IF_UPPER) & starts_upper(token))
    )


def suffix_eliminated(
    suffix: Column,
    stem: Column,
    token: Column,
    lstem_pos: Column,
    lstem_in_lexicon: Column,
    probe_hit: Column,
) -> Column:
    """True if a suffix reading must be discarded.

    ``lstem_*`` describe the lexicon entry of ``lower(stem)``; ``probe_hit``
    is the raw-case probe of ``stem + 'et'`` for suffix ``ette``.
    """
    last = last_char(stem, 1)
    adjective_e = starts_upper(stem) & lstem_in_lexicon & F.coalesce(lstem_pos.isin(ADJ_POS), F.lit(False))
    return (
        ((suffix == "chen") & ((last == "s") | ~char_is_consonant(last)))
        | (_in(suffix, SUFFIX_DROP_IF_LOWER) & starts_lower(token))
        | (_in(suffix, SUFFIX_DROP_IF_UPPER) & starts_upper(token))
        | ((suffix == "e") & ~adjective_e)
        | ((suffix == "age") & (stem.endswith("sl") | stem.endswith("st") | all_consonants(last_char(stem, 3))))
        | (suffix == "ens")
        | ((suffix == "ette") & probe_hit)
        | (_in(suffix, SUFFIX_NEED_CONSONANT) & ~char_is_consonant(last))
        | ((suffix == "tel") & (last == "t"))
        | ((suffix == "er") & (last == "i"))
    )


def probe_key(suffix: Column, stem: Column) -> Column:
    """Raw-case key of the second lexicon probe, null if the suffix needs none."""
    expr = F.lit(None).cast("string")
    for sfx, tail in PROBE_SUFFIX.items():
        expr = F.when(suffix == sfx, F.concat(stem, F.lit(tail))).otherwise(expr)
    return expr


def prefix_rule_base(prefix: Column, stem: Column, token: Column) -> Column:
    """Base recovered by rule for a prefixed stem, null if none is found."""
    verbal = _in(prefix, PREFIX_VERBAL) & ~stem.startswith("ge") & starts_lower(token)
    long = F.length(stem) > 6
    latinate = _in(prefix, PREFIX_LATINATE)
    base = (
        F.when(all_consonants(stem) | _in(prefix, PREFIX_NO_BASE), F.lit(None))
        .when(verbal & long & stem.endswith("ende"), drop_last(stem, 2))
        .when(verbal & long & stem.endswith("enden"), drop_last(stem, 3))
        .when(verbal & (stem.endswith("en") | stem.endswith("ern")), stem)
        .when(latinate & stem.endswith("e"), drop_last(stem, 1))
        .when(latinate & stem.endswith("en"), drop_last(stem, 2))
        .when(latinate & (stem.endswith("ion") | stem.endswith("nal")), stem)
    )
    return base


def _fb(found, base) -> Column:
    if isinstance(found, bool):
        found = F.lit(found)
    if base is None:
        base = F.lit(None)
    return F.struct(found.alias("found"), base.cast("string").alias("base"))


def suffix_rule_base(suffix: Column, stem: Column, probe_hit: Column, probe_base: Column) -> Column:
    """struct(found, base) recovered by rule for a suffixed stem.

    ``probe_hit``/``probe_base`` come from the raw-case lexicon probe of
    ``probe_key`` (``stem+'e'`` for ig/isch, ``stem+'en'`` for ner).
    A found base may be null only when a lexicon entry has no base.
    """
    lower = F.lower
    ends = stem.endswith
    second_last = F.substring(stem, -2, 1)
    found_base = (
        F.when(all_consonants(stem), _fb(False, None))
        .when(_in(suffix, SUFFIX_CONFIX), _fb(False, None))
        .when(_in(suffix, SUFFIX_BASE_IS_STEM), _fb(True, stem))
        .when(suffix == "ung", _fb(True, lower(F.concat(stem, F.when(ends("r"), "n").otherwise("en")))))
        .when(
            suffix == "lich",
            _fb(
                True,
                F.when(stem.contains("äu"), title_word(F.replace(stem, F.lit("ä"), F.lit("a"))))
                .when(stem.contains("ö"), title_word(F.replace(stem, F.lit("ö"), F.lit("o"))))
                .when(ends("er"), F.concat(stem, F.lit("n")))
                .otherwise(F.concat(stem, F.lit("en"))),
            ),
        )
        .when(
            suffix == "er",
            _fb(True, F.when(ends("tik"), stem).otherwise(lower(F.concat(stem, F.lit("en"))))),
        )
        .when(
            (suffix == "ig") & ends("r") & char_is_consonant(second_last) & ~second_last.isin("r", "h"),
            _fb(True, F.concat(drop_last(stem, 1), F.lit("er"))),
        )
        .when(suffix.isin("ig", "isch"), _fb(probe_hit, F.when(probe_hit, probe_base)))
        .when(
            suffix == "weise",
            _fb(
                True,
                F.when(ends("s"), drop_last(stem, 1)).when(ends("er"), drop_last(stem, 2)).otherwise(stem),
            ),
        )
        .when(
            suffix == "bar",
            _fb(True, F.concat(stem, F.when(ends("er"), "n").otherwise("en"))),
        )
        .when(suffix == "e", _fb(True, lower(stem)))
        .when(
            suffix.isin("end", "nd"),
            _fb(
                True,
                F.concat(lower(stem), F.when(ends("e") | ends("r") | ends("l"), "n").otherwise("en")),
            ),
        )
        .when(suffix == "ur", _fb(True, F.when(ends("e"), drop_last(stem, 1)).otherwise(stem)))
        .when(suffix == "dings", _fb(True, F.when(ends("er"), drop_last(stem, 2)).otherwise(stem)))
        .when(
            suffix == "ell",
            _fb(True, title_word(F.when(ends("in"), F.concat(stem, F.lit("al"))).otherwise(stem))),
        )
        .when(suffix == "los", _fb(True, F.when(ends("s"), drop_last(stem, 1)).otherwise(stem)))
        .when(suffix == "ner", _fb(probe_hit, F.when(probe_hit, probe_base)))
        .otherwise(_fb(False, None))
    )
    return found_base
