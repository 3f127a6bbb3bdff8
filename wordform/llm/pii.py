"""Personal data: base patterns and a semi-Markov conditional random field.

The base patterns (e-mail, IP address, card, phone) are matched over the whole
text. Around every digit, ``@`` and spelled-out ``at``/``dot`` (in any case: in
brackets, ``dot`` as a word, ``at`` before a name with dots or a ``dot``) a region of tokens
is cut; the field scores whole candidate spans of it (at most ``SPAN`` tokens)
by features of the span as a unit: its shape, digits, check digit, separators,
the characters beside it and the word before it. A forward-backward pass over
segmentations trains it, and dynamic programming over boundaries and types with
entities of bounded length picks the best segmentation. Spans that it finds and
that overlap no base span are added; base spans always stay.

It is learned from base spans of a bounded sample of regions (``SAMPLE``, those
of the different texts with the smallest hashes; stretches of ``TRAIN_CHARS`` at most) and from rewritings of them that the
base patterns miss (spelled-out e-mails, defanged addresses, grouped cards,
phones without ``+``), half of the e-mails without digits; digits that no base
pattern takes, and words around ``at`` alone, teach it what to leave.

Null and empty texts have no spans. Repeated rows are judged alike. Offsets are
code points, ends exclusive. Other columns are not read."""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordform.llm.common import map_arrow, map_text, table

KINDS = ("email", "ip", "card", "phone")
#: Tokens of a span at most, tokens of context on either side of a trigger.
SPAN = 18
CONTEXT = 60
SAMPLE = 400
EPOCHS = 6
TRAIN_CHARS = 600

Span = tuple[int, int, int]  # start, kind, end

# -- base patterns ------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive, and not from within a number: a number that fails from its start fails from each digit
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns, leftmost and non-overlapping per kind, by start and kind."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            free = m.end()
            out.append((start, 0, free))
        at = text.find("@", max(at + 1, free))
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m.group())) <= 15]
    return sorted(out)


# -- regions and span features --------------------------------------------------

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
# at or dot in brackets, dot as a word, at before a name with dots
_SPELLED = re.compile(r"[\[({]\s*+(?:at|dot)\s*+[\])}]|\b(?:dot|at\b(?=\s++[a-z0-9-]++\.[a-z0-9-]|.{1,40}\bdot\b))\b", re.IGNORECASE)
_DOT = r"(?:\.|\s*[\[({]\s*dot\s*[\])}]\s*|\s+dot\s+)"
#: A whole address in any of these forms: names with dots, at, names with a dot or more.
_ADDRESS = re.compile(rf"[\w%+-]+(?:{_DOT}[\w%+-]+)*(?:\s*[\[({{]\s*at\s*[\])}}]\s*|\s+at\s+|\s*@\s*)[\w-]+(?:{_DOT}[\w-]+)+", re.IGNORECASE)
_MARKS = re.compile(r"[0-9@]+")
_ENDS = set(")]}")


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches of text around triggers; close ones are one region."""
    marks = sorted([m.span() for m in _MARKS.finditer(text)] + [m.span() for m in _SPELLED.finditer(text)])
    out: list[list[int]] = []
    for a, b in marks:
        if out and a - CONTEXT <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + CONTEXT)
        else:
            out.append([max(0, a - CONTEXT), b + CONTEXT])
    return [(a, min(b, len(text))) for a, b in out]


def _shape(s: str) -> str:
    out = []
    for t in _TOKEN.finditer(s):
        w = t.group()
        if w.isdigit():
            out.append("9" * min(len(w), 5))
        elif w.isalnum():
            out.append("dot" if w.lower() == "dot" else "at" if w.lower() == "at" else "a9" if any(c.isdigit() for c in w) else "a")
        else:
            out.append(w)
    return "".join(out)


def _side(c: str) -> str:
    return "^" if not c else "s" if c.isspace() else "a" if c.isalnum() else c if c in "@.-+_/:=" else "p"


Candidate = tuple[int, int, list[str]]


def candidates(text: str, a: int, b: int) -> tuple[list[tuple[int, int]], Iterator[Candidate]]:
    """Tokens of a region and its candidate spans: (first token, token after the last,
    features). They are made one at a time, left to right: a region without an end,
    such as a table of numbers, has many times more of them than tokens."""
    spans = [(m.start() + a, m.end() + a) for m in _TOKEN.finditer(text[a:b])]
    return spans, _candidates(text, spans)


def _candidates(text: str, spans: list[tuple[int, int]]) -> Iterator[Candidate]:
    words = [text[s:e] for s, e in spans]
    digits = [sum("0" <= c <= "9" for c in w) for w in words]
    worded = [w.lower() in ("at", "dot") for w in words]
    mark = [d > 0 or w == "@" or spelled for d, w, spelled in zip(digits, words, worded)]
    for i, w in enumerate(words):
        if not (w[0].isalnum() or w in "+([") or not any(mark[i : i + SPAN]):
            continue
        n, seen, at = 0, False, False
        for j in range(i, min(i + SPAN, len(words))):
            gap = text[spans[j - 1][1] : spans[j][0]] if j > i else ""
            if "\n" in gap or (len(gap) > 1 and not worded[j] and not worded[j - 1]):
                break
            n += digits[j]
            seen |= mark[j]
            at |= words[j] == "@" or words[j].lower() == "at"
            last = words[j]
            if not seen or not (last[-1].isalnum() or last in _ENDS) or not (at or n >= 4) or n > 24:
                continue
            s, e = spans[i][0], spans[j][1]
            whole = text[s:e]
            figures = "".join(c for c in whole if "0" <= c <= "9")
            numbers = re.findall("[0-9]+", whole)
            letters = any(c.isalpha() for c in whole)
            plain = "l" if letters else "n"
            shape = _shape(whole)
            before = words[i - 1].lower() if i and words[i - 1].isalpha() else ""
            f = [
                "1",
                f"sh{shape if len(shape) < 48 else len(shape)}",
                f"nd{n}{plain}",
                f"g{len(numbers)}{plain}",
                f"at{whole.count('@')}{at}{'.' in whole}{'dot' in shape}",
                f"ad{at and bool(_ADDRESS.fullmatch(whole))}",
                f"lu{n >= 13 and luhn(figures)}{n >= 13}{plain}",
                f"oc{len(numbers) == 4 and all(map(_small, numbers))}{plain}",
                f"l{_side(text[s - 1 : s])}{_shape(whole[:1])}",
                f"r{_side(text[e : e + 1])}{'s' if last[-1].isalpha() else 'e'}{plain}",
                f"rr{_side(text[e : e + 1])}{_side(text[e + 1 : e + 2])}{at}",
                f"f{whole[0] if not whole[0].isalnum() else 'a'}{plain}",
                f"sp{min(whole.count(' '), 8)}{plain}{at}",
                f"w{before}" if len(before) < 9 else "w",
                f"sep{''.join(sorted(set(re.findall(r'[^0-9A-Za-z]', whole)))[:4])}{plain}",
            ]
            yield i, j + 1, f


# -- the field ------------------------------------------------------------------


class Field:
    """Weights: feature -> one per kind; ``beside`` scores an entity right after another."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.w = np.zeros((0, len(KINDS)))
        self.beside = 0.0

    def scores(self, cands: Iterable[Candidate]) -> list[tuple[int, int, int, float]]:
        """Best kind and score of each candidate."""
        get, w, out = self.index.get, self.rows, []
        for i, j, f in cands:
            t = [0.0] * len(KINDS)
            for name in f:
                k = get(name)
                if k is not None:
                    r = w[k]
                    t = [t[0] + r[0], t[1] + r[1], t[2] + r[2], t[3] + r[3]]
            best = max(t)
            if best > 0:
                out.append((i, j, t.index(best), best))
        return out

    def decode(self, n: int, scored: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
        """Best segmentation of n tokens into entities and single others: the
        state is whether an entity ends here; a candidate with a score of 0 or
        less is never in it, so they need not be looked at."""
        ends: dict[int, list] = {}
        for c in scored:
            ends.setdefault(c[1], []).append(c)
        free, taken, how = [0.0] * (n + 1), [-1e9] * (n + 1), [None] * (n + 1)
        for p in range(1, n + 1):
            free[p] = max(free[p - 1], taken[p - 1])
            for c in ends.get(p, ()):
                s = c[3] + max(free[c[0]], taken[c[0]] + self.beside)
                if s > taken[p]:
                    taken[p], how[p] = s, c
        out, p, inside = [], n, taken[n] > free[n]
        while p > 0:
            if inside:
                i, j, kind, _ = how[p]
                out.append((i, j, kind))
                p = i
                inside = taken[p] + self.beside > free[p]
            else:
                p -= 1
                inside = taken[p] > free[p]
        return out[::-1]

    @property
    def rows(self) -> list[tuple[float, ...]]:
        if not hasattr(self, "_rows") or len(self._rows) != len(self.w):
            self._rows = [tuple(r) for r in self.w.tolist()]
        return self._rows

    def fit(self, data: list[tuple[str, list[Span]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4) -> Field:
        """Conditional likelihood by stochastic gradients (AdaGrad) over regions with their spans."""
        prepared, counts = [], {}
        for text, gold in data:
            spans, cands = candidates(text, 0, len(text))
            cands = list(cands)
            at = {(s, e): kind for s, kind, e in gold}
            truth = [at.get((spans[i][0], spans[j - 1][1]), -1) for i, j, _ in cands]
            if cands:
                prepared.append((len(spans), cands, truth))
                for (_, _, f), t in zip(cands, truth):
                    for name in f:
                        counts[name] = counts.get(name, 0) + (5 if t >= 0 else 1)
        self.index = {name: k for k, name in enumerate(sorted(c for c, n in counts.items() if n >= 3))}
        w = np.zeros((len(self.index), len(KINDS)))
        seen = np.full_like(w, 1e-3)
        rng = random.Random(11)
        packed = []
        for n, cands, truth in prepared:
            width = max(len(f) for _, _, f in cands)
            ids = np.array([[self.index.get(x, -1) for x in f] + [-1] * (width - len(f)) for _, _, f in cands])
            packed.append((n, np.array([c[0] for c in cands]), np.array([c[1] for c in cands]), ids, np.array(truth)))
        for _ in range(epochs):
            rng.shuffle(packed)
            for n, first, stop, ids, truth in packed:
                s = np.where(ids[:, :, None] >= 0, w[ids], 0).sum(1)  # candidates, kinds
                whole = np.logaddexp.reduce(s, axis=1)
                forward, backward = np.zeros(n + 1), np.zeros(n + 1)
                by_stop, by_first = {}, {}
                for c, (i, j) in enumerate(zip(first.tolist(), stop.tolist())):
                    by_stop.setdefault(j, []).append(c)
                    by_first.setdefault(i, []).append(c)
                for p in range(1, n + 1):
                    c = by_stop.get(p)
                    forward[p] = forward[p - 1] if c is None else np.logaddexp.reduce(np.append(forward[first[c]] + whole[c], forward[p - 1]))
                for p in range(n - 1, -1, -1):
                    c = by_first.get(p)
                    backward[p] = backward[p + 1] if c is None else np.logaddexp.reduce(np.append(backward[stop[c]] + whole[c], backward[p + 1]))
                g = np.exp(np.minimum(forward[first][:, None] + s + backward[stop][:, None] - forward[n], 0))
                known = truth >= 0
                g[np.flatnonzero(known), truth[known]] -= 1
                rows, cols = np.nonzero(ids >= 0)
                k = ids[rows, cols]
                step = np.zeros_like(w)
                np.add.at(step, k, g[rows])
                used = np.unique(k)
                d = step[used] + decay * w[used]
                seen[used] += d * d
                w[used] -= rate * d / np.sqrt(seen[used])
        self.w = w
        return self


# -- training data ----------------------------------------------------------------


def without_digits(user: str, host: str) -> tuple[str, str]:
    """Both parts of an address without digits; a part that then has an empty name stays."""
    user = re.sub("[0-9]", "", user).strip("._%+-") or user
    bare = re.sub("[0-9]", "", host)
    return user, bare if all(bare.split(".")) else host


def rewritten(text: str, span: Span, rng: random.Random) -> tuple[str, Span] | None:
    """The text with one span in a form that the base patterns don't take."""
    start, kind, end = span
    s = text[start:end]
    if kind == 0:
        user, host = s.split("@", 1)
        if rng.random() < 0.5:  # an address needs no digits
            user, host = without_digits(user, host)
            host = rng.choice([host, host.split(".", 1)[1] if host.count(".") > 1 else host])
        at = rng.choice([" at ", " [at] ", "[at]", " (at) ", "(at)", " @ "])
        dot = rng.choice([" dot ", "[dot]", " [dot] ", "(dot)", ".", "."]) if at != " @ " else "."
        if rng.random() < 0.4:  # other brackets, spaces within them, capitals
            opening, closing = rng.choice(["{}", "[]", "()"])
            gap, beside = rng.choice(["", " ", "  "]), rng.choice(["", " "])
            form = lambda word: f"{beside}{opening}{gap}{word}{gap}{closing}{beside}"
            at, dot = form("at"), rng.choice([form("dot"), "."])
        if rng.random() < 0.3:
            change = rng.choice([str.upper, str.title])
            at, dot = change(at), change(dot)
        new = user + at + host.replace(".", dot)
    elif kind == 1:
        new = s.replace(".", rng.choice(["[.]", "(.)", " . ", "[dot]", "-"]))
    elif kind == 2:
        d, sep = re.sub("[^0-9]", "", s), rng.choice([".", "/", "_", " - ", " -"])
        new = sep.join(d[i : i + 4] for i in range(0, len(d), 4))
    else:
        d = re.sub("[^0-9]", "", s)[-10:]
        new = rng.choice(["{0}-{1}-{2}", "({0}) {1}-{2}", "{0}.{1}.{2}", "{0} {1} {2}", "001 {0} {1} {2}", "tel {0} {1}{2}"]).format(d[:3], d[3:6], d[6:])
        if new.startswith("tel "):
            return text[:start] + new + text[end:], (start + 4, kind, start + len(new))
    return text[:start] + new + text[end:], (start, kind, start + len(new))


def training_set(found: list[tuple[str, list[Span]]], seed: int = 5) -> list[tuple[str, list[Span]]]:
    """Regions as found, and each with a base span once more with that span rewritten."""
    rng = random.Random(seed)
    out = list(found)
    for text, gold in found:
        if len(gold) == 1:
            for _ in range(6 if gold[0][1] == 0 else 2):  # e-mails have the most forms
                new, span = rewritten(text, gold[0], rng)
                out.append((new, [span]))
            start, kind, end = gold[0]
            if kind == 0:  # words on either side of "at" alone are no address
                user, host = without_digits(*text[start:end].split("@", 1))
                out.append((f"{text[:start]}{user.split('.')[0]} at {host.split('.')[0]}{text[end:]}", []))
    return out


def within(base: list[Span], a: int, b: int) -> list[Span]:
    """The spans that lie in ``a`` to ``b``."""
    return [s for s in base[bisect_left(base, (a,)) : bisect_left(base, (b,))] if s[2] <= b]


def stretches(a: int, b: int, base: list[Span]) -> list[tuple[int, int]]:
    """A region, or of a longer one the first ``TRAIN_CHARS`` and the last, each ended so
    that it cuts no base span (left out where a span is as long as that)."""
    if b - a <= TRAIN_CHARS:
        return [(a, b)]
    out = []
    for x, y in ((a, a + TRAIN_CHARS), (b - TRAIN_CHARS, b)):
        for s, _, e in base[: bisect_left(base, (y,))]:
            if s < x < e:
                x = e
            if s < y < e:
                y = min(y, s)
        if y > x:
            out.append((x, y))
    return out


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE, seed: int = 5) -> Field:
    """Learn a field from regions of at most ``sample`` texts that have any trigger."""
    some = (
        docs.select(F.col(text).cast("string").alias("text"))
        .where(F.col("text").rlike("[0-9@]"))
        .select("text", F.xxhash64("text").alias("h"))
    )
    n = some.select("h").distinct().count()
    some = some.where(F.pmod("h", F.lit(1 << 40)) < int((1 << 40) * min(1.0, sample / max(n, 1)))).select("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, golds = [], []
            for t in batch.column(0).to_pylist():
                base = base_spans(t)
                cuts = regions(t)
                for a, b in cuts[:: max(1, len(cuts) // 4)]:
                    for a, b in stretches(a, b, base):
                        texts.append(t[a:b])
                        golds.append([{"s": s - a, "k": k, "e": e - a} for s, k, e in within(base, a, b)])
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(golds, gold_type)], names=["text", "gold"])

    gold_type = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))
    rows = map_arrow(some, cut, "text string, gold array<struct<s:int,k:int,e:int>>").distinct().collect()
    found = sorted((r["text"], [(g["s"], g["k"], g["e"]) for g in r["gold"]]) for r in rows)
    random.Random(seed).shuffle(found)
    return Field().fit(training_set(found[: 2 * sample], seed))


def find(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans)."""
    base = base_spans(text)
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))  # the furthest end so far
    added = []
    for a, b in regions(text):
        spans, cands = candidates(text, a, b)
        for i, j, kind in field.decode(len(spans), field.scores(cands)):
            s, e = spans[i][0], spans[j - 1][1]
            before = bisect_left(starts, e)
            if not before or reach[before - 1] <= s:
                added.append((s, kind, e))
    return base, sorted(base + added)


def digest(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
            at = e
        elif e > at:
            at = e
    return "".join(out + [text[at:]])


_COLUMNS = {
    **{f"n_{k}": ("bigint", pa.int64()) for k in KINDS},
    "base_sha256": ("string", pa.string()),
    "spans": ("string", pa.string()),
    "redacted": ("string", pa.string()),
}


def scan(docs: DataFrame, field: Field, keep: list[str], outputs: list[str], text: str = "text") -> DataFrame:
    """Per row, the columns ``keep`` and any of ``n_<kind>`` (base spans),
    ``base_sha256``, ``spans`` (all of them) and ``redacted`` (the text with
    every span masked; null stays null)."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        field = shared.value

        def run(texts: pa.Array) -> dict[str, pa.Array]:
            got: dict[str, list] = {c: [] for c in _COLUMNS}
            for t in texts.to_pylist():
                base, spans = find(t, field) if t else ([], [])
                for k, kind in enumerate(KINDS):
                    got[f"n_{kind}"].append(sum(x[1] == k for x in base))
                got["base_sha256"].append(hashlib.sha256(digest(base).encode()).hexdigest())
                got["spans"].append(digest(spans))
                got["redacted"].append(masked(t, spans) if spans else t)
            return {c: pa.array(got[c], _COLUMNS[c][1]) for c in outputs}

        return run

    return map_text(docs, keep, make, ", ".join(f"{c} {_COLUMNS[c][0]}" for c in outputs), text)


def op9_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document; ``n_<kind>`` count base spans."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs, fit(docs), ["doc_id"], [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
