"""Character-class predicates and case helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the letters that count as consonants (lower case only; upper
# case letters and "ß" are not consonants).
CONSONANTS = "bcdfghjklmnpqrstvwxyz"

_ALL_CONSONANTS_RE = rf"^[{CONSONANTS}]*\z"


def all_consonants(c: Column) -> Column:
    """Every character is a consonant (the empty string counts as true)."""
    return c.rlike(_ALL_CONSONANTS_RE)


def char_is_consonant(c: Column) -> Column:
    """``c`` is a single character (possibly empty); true if it is a consonant
    or empty, like the all-characters test applied to one character."""
    return c.rlike(_ALL_CONSONANTS_RE)


def last_char(c: Column, n: int = 1) -> Column:
    """The last ``n`` characters (fewer if the string is shorter)."""
    return F.when(F.length(c) >= n, F.substring(c, -n, n)).otherwise(c)


def has_digit(c: Column) -> Column:
    """Any Unicode decimal digit (Python ``\\d`` on str)."""
    return c.rlike(r"\p{Nd}")


def starts_upper(c: Column) -> Column:
    """``s[0].isupper()`` (Unicode Uppercase property, as Python uses)."""
    return c.rlike(r"^\p{IsUppercase}")


def starts_lower(c: Column) -> Column:
    """``s[0].islower()`` (Unicode Lowercase property, as Python uses)."""
    return c.rlike(r"^\p{IsLowercase}")


def title_word(c: Column) -> Column:
    """``str.title()``: every letter run starts upper case, the rest of the
    run is lower case (``bauer-hof`` → ``Bauer-Hof``). Letter runs and the
    characters between them are title-cased one by one and joined again."""
    pieces = F.regexp_extract_all(c, F.lit(r"\p{L}+|\P{L}+"), 0)
    return F.when(c.rlike(r"^\p{L}*\z"), F.initcap(c)).otherwise(
        F.array_join(F.transform(pieces, lambda x: F.initcap(x)), "")
    )


def drop_last(c: Column, n: int) -> Column:
    """``s[:-n]``"""
    return c.substr(F.lit(1), F.greatest(F.length(c) - n, F.lit(0)))
