"""A rule tokeniser: words between white space are peeled from both ends, one mark
at a time, until an exception or a word is left; in Columns only.

1. Marks of ``OPENING`` come off the front, then marks of ``CLOSING`` off the back. Peeling
   stops as soon as what is left is an exception of the table ("z.B.", "Dr.", ":)"), one
   letter with its full stop ("J."), or a whole number with its full stop (an ordinal) that
   is not the last word of the text.
2. An exception gives the pieces that the table has for it. Addresses (``://``, ``www.``, ``@``)
   and numbers ("3,5", "12:30", "2024-01-15") stay whole. Any other word is cut around the marks
   of ``INNER`` and ``--``, around a full stop between a small letter and a capital, and before
   a clitic ("geht's").
3. Every peeled mark is a token; several full stops in a row are one.

The exceptions travel as a literal of hash buckets. Peeling folds over the ends that an
exception can have, which its longest entry bounds, not over the word, so a word of a million
marks takes time in proportion. A null text gives null, one of white space only an empty array.
``RuleTokenizer().tokenize`` is a token model for ``sentences`` and ``find_derivatives``."""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordform.functions.text import NOT_WS

OPENING = "\"'([{<„“”‚‘’»«›‹¿¡§#*_~"
CLOSING = ".,;:!?…\"')]}>“”‘’»«›‹%€$°*_~"
INNER = r"""[/&=<>:;,!?…()\[\]{}"“”„«»]|-{2,}"""
NUMBER = r"^[+-]?[0-9]+(?:[.,:/–-][0-9]+)*$"
ADDRESS = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://|www\.)|^[^@]+@[^@]+\.[^@]+$"
CLITIC = r"(\p{L})(['’][sS])$"
JOINED = r"(\p{Ll})\.(\p{Lu})"
MARKS = r"\.{2,}|(?s:.)"
#: Cuts within a word; white space, so that no word holds it.
CUT = "\x1f"
#: Abbreviations and faces that the default table keeps; "z.B." and its kind become two tokens.
WHOLE = (
    "abs. allg. bspw. bzgl. bzw. ca. dipl. dr. ebd. etc. evtl. exkl. fr. ggf. hr. hrsg. inkl. jh. kap. max. min. "
    "mio. mrd. nr. prof. s. sog. st. str. tel. u. usf. usw. v. vgl. vs. zzgl. :) :( ;) :D :P :/ :-) :-( ;-) :-D <3 ^^"
).split()
PAIRS = "z.B. d.h. u.a. z.T. i.d. s.o. s.u. o.ä. v.a. m.E. i.A. n.Chr. v.Chr.".split()


def default_exceptions() -> dict[str, tuple[str, ...]]:
    """Words and their pieces; abbreviations also with a capital."""
    whole = {w: (w,) for w in (*WHOLE, *(w.capitalize() for w in WHOLE if w[0].isalpha()))}
    pairs = {w: tuple(p + "." for p in w.rstrip(".").split(".")) for w in (*PAIRS, *(w[0].upper() + w[1:] for w in PAIRS))}
    return {**whole, **pairs}


class _Table:
    """Words and their pieces as a literal of hash buckets."""

    def __init__(self, entries: dict[str, tuple[str, ...]]) -> None:
        self.longest = max(map(len, entries), default=0)
        self.size = len(entries)
        buckets: list[list[str]] = [[] for _ in entries]
        for w in sorted(entries):
            if not w or any(c.isspace() for c in "".join((w, *entries[w]))) or "".join(entries[w]) != w:
                raise ValueError(f"the pieces of an exception make up the word, without white space: {w!r}")
            buckets[zlib.crc32(w.encode()) % self.size].append(CUT.join((w, *entries[w])))
        self.buckets = "\n".join(f" {' '.join(b)} " for b in buckets)

    def _bucket(self, w: Column) -> Column:
        if not self.size:
            return F.lit("")
        return F.get(F.split(F.lit(self.buckets), "\n"), (F.crc32(F.encode(w, "utf-8")) % self.size).cast("int"))

    def has(self, w: Column) -> Column:
        return F.contains(self._bucket(w), F.concat(F.lit(" "), w, F.lit(CUT)))

    def pieces(self, w: Column) -> Column:
        behind = F.call_function("substring_index", self._bucket(w), F.concat(F.lit(" "), w, F.lit(CUT)), F.lit(-1))
        return F.split(F.substring_index(behind, " ", 1), CUT)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _marks(run: Column) -> Column:
    return F.regexp_extract_all(run, F.lit(MARKS), 0)


def _inner(core: Column) -> Column:
    """Pieces of a word that has no marks to peel."""
    cut = F.regexp_replace(core, f"({INNER})", f"{CUT}$1{CUT}")
    cut = F.regexp_replace(cut, JOINED, f"$1{CUT}.{CUT}$2")
    cut = F.regexp_replace(cut, CLITIC, f"$1{CUT}$2")
    parts = F.filter(F.split(cut, CUT), lambda p: p != "")
    return F.when(core.rlike(NUMBER) | core.rlike(ADDRESS), F.array(core)).otherwise(parts)


@dataclass(frozen=True)
class RuleTokenizer:
    """``exceptions``: words and the pieces that make them up."""

    exceptions: dict[str, tuple[str, ...]] = field(default_factory=default_exceptions)

    def with_abbreviations(self, types: Iterable[str]) -> RuleTokenizer:
        """Also keeps lower-case abbreviations without their full stops, as
        ``SentenceModel.abbreviations`` has them, in small letters and capitalised."""
        more = {w + ".": (w + ".",) for t in types for w in (t, t[:1].upper() + t[1:])}
        return RuleTokenizer({**more, **self.exceptions})

    def tokenize(self, text: Column) -> Column:
        """array<string>: the tokens of a text (a sentence)."""
        table = _Table(self.exceptions)
        lettered = any(w.isalpha() for w in self.exceptions)

        def of_words(words: Column) -> Column:
            def tokens(w: Column, i: Column) -> Column:
                plain = w.rlike(r"^\p{L}+$") & (~table.has(w) if lettered else F.lit(True))
                return F.when(plain, F.array(w)).otherwise(_peeled(table, w, i == F.size(words) - 1))

            return F.flatten(F.transform(words, tokens))

        return _bind(F.regexp_extract_all(text, F.lit(f"{NOT_WS}+"), 0), of_words)


def _peeled(table: _Table, w: Column, last: Column) -> Column:
    def first(begin: Column, end: Column, found) -> Column:
        """The first number from ``begin`` to ``end`` for which ``found`` holds; null: none."""
        every = F.when(begin <= end, F.sequence(begin, end)).otherwise(F.array().cast("array<int>"))
        none = F.lit(None).cast("int")
        return F.aggregate(every, none, lambda at, n: F.when(at.isNotNull(), at).when(found(n), n))

    def front(w: Column) -> Column:
        # an exception before all opening marks are off
        n, opening = F.length(w), F.length(w) - F.length(F.ltrim(w, F.lit(OPENING)))
        at = first(F.greatest(F.lit(0), n - table.longest), opening, lambda i: table.has(F.substring(w, i + 1, n)))
        return _bind(F.struct(at.alias("at"), opening.alias("opening")), lambda s: both(w, n, s))

    def both(w: Column, n: Column, s: Column) -> Column:
        at = F.coalesce(s["at"], s["opening"])
        left, rest = F.substring(w, F.lit(1), at), F.substring(w, at + 1, n)
        return _bind(rest, lambda r: F.concat(_marks(left), F.when(s["at"].isNotNull(), table.pieces(r)).otherwise(back(r))))

    def back(r: Column) -> Column:
        n, core = F.length(r), F.rtrim(r, F.lit(CLOSING))
        closing = n - F.length(core)
        at = first(F.greatest(F.lit(0), n - table.longest), closing - 1, lambda j: table.has(F.substring(r, F.lit(1), n - j)))
        state = F.struct(at.alias("at"), core.alias("core"), F.substring(r, F.length(core) + 1, n).alias("right"))
        return _bind(state, lambda s: middle(r, n, s))

    def middle(r: Column, n: Column, s: Column) -> Column:
        core, right = s["core"], s["right"]
        stop = right.startswith(".") & (core.rlike(r"^\p{L}$") | (core.rlike("^[0-9]+$") & ~(last & (right == "."))))
        word = F.when(table.has(core), table.pieces(core)).otherwise(_inner(core))
        return (
            F.when(s["at"].isNotNull(), F.concat(table.pieces(F.substring(r, F.lit(1), n - s["at"])), _marks(F.substring(r, n - s["at"] + 1, n))))
            .when(stop, F.concat(F.array(F.concat(core, F.lit("."))), _marks(F.substring(right, 2, 1 << 30))))
            .when(core == "", _marks(right))
            .otherwise(F.concat(word, _marks(right)))
        )

    return front(w)
