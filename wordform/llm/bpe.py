"""BPE encoding and decoding by prefix-sharing trie traversal.

Byte-level BPE has one valid encoding per word, and its last token depends on
the prefix alone: a token t that ends a prefix is the last one if it starts
the word or if the last token p of the prefix before t is compatible with it,
that is if BPE leaves the bytes of p and t as exactly these two tokens. So the
distinct words of a slice of texts form a trie, and a depth-first walk carries
the last token of each prefix: a prefix that many words share is computed once.
Visiting the sorted words with a stack that is cut back to the common prefix of
neighbours is that walk, without nodes in memory.

Encodings of words are kept per task (up to ``MAX_KEPT`` of them, then the
table starts anew), so a frequent word is encoded once per task at most.

Null is the empty text: no tokens, empty decoding. Repeated rows give repeated
rows. Texts of any length are taken whole; a word costs time in proportion to
its length times the longest token. Other columns are not read."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

from wordform.llm.common import map_text, table

MAX_KEPT = 250_000
#: Longer words are encoded anew each time.
MAX_KEPT_LENGTH = 256

# Fixed values of byte-level BPE: the white space of its word pattern and the
# printable bytes that stand for themselves.
_SPACE = "\t-\r \x85\xa0  -     　"
_PLAIN = [range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100)]


def char_classes() -> dict[str, list[int]]:
    """Code points that the library takes for letters (L) and numbers (N).
    Python's Unicode tables say so for what they know; characters that are newer
    (``regex`` knows more) are tried in the library's own word splitter."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    kinds = [unicodedata.category(c) for c in points]
    newer = regex.findall(r"\P{Cn}", "".join(c for c, k in zip(points, kinds) if k == "Cn"))
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    out = {}
    for kind, probe in (("L", "a"), ("N", "1")):
        spans = {span for _, span in split("\n".join(probe + c for c in newer))}
        late = [c for i, c in enumerate(newer) if (3 * i, 3 * i + 2) in spans]
        out[kind] = sorted(ord(c) for c in [*(c for c, k in zip(points, kinds) if k[0] == kind), *late])
    return out


def word_pattern(classes: dict[str, list[int]], limit: int = 0x110000) -> re.Pattern:
    """The word pattern for texts whose code points are all below ``limit``.
    Ranges in a class of ``re`` are faster than properties of ``regex``."""

    def ranges(points: list[int]) -> str:
        p = np.array([c for c in points if c < limit])
        cut = np.flatnonzero(np.diff(p) != 1) + 1
        return "".join(f"{re.escape(chr(r[0]))}-{re.escape(chr(r[-1]))}" for r in np.split(p, cut))

    letter, number = ranges(classes["L"]), ranges(classes["N"])
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{_SPACE}{letter}{number}]+"
        rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
    )


class Model:
    """Vocabulary, merges and added tokens of a tokenizer file."""

    def __init__(self, definition: str, classes: dict[str, list[int]]):
        spec = json.loads(definition)
        model = spec["model"]
        plain = [b for r in _PLAIN for b in r]
        odd = [b for b in range(256) if b not in set(plain)]
        of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}
        raw = lambda token: bytes(of[c] for c in token)
        self.ids = {raw(t): i for t, i in model["vocab"].items()}
        self.bytes = {i: b for b, i in self.ids.items()}
        #: pair -> (order of the merge, merged token); token -> (order, left, right)
        self.merges: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for order, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = self.ids[raw(left)], self.ids[raw(right)]
            self.merges[a, b] = order
            self.parts.setdefault(self.ids[raw(left) + raw(right)], (order, a, b))
        self.longest = max(map(len, self.ids))
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for content, i in self.added.items():
            self.bytes[i] = content.encode()
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.patterns = {limit: word_pattern(classes, limit) for limit in (0x80, 0x10000, 0x110000)}
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.kept: dict[str, bytes] = {}
        #: Tokens that BPE makes of their own bytes; no other can be in an encoding.
        self.usable = {b: i for b, i in self.ids.items() if self.reachable(i)}

    def _stays_apart(self, a: int, b: int, before: float) -> bool:
        """Whether no merge over the border of a and b comes before those that
        make a and b. Undo their merges, the latest first (of equal ones the
        right one, as BPE goes from left to right), and look at the border."""
        merges, parts = self.merges, self.parts
        while True:
            if merges.get((a, b), before) < before:
                return False
            made_a, made_b = parts.get(a), parts.get(b)
            if made_b is not None and (made_a is None or made_b[0] >= made_a[0]):
                before, b = made_b[0] + 1, made_b[1]
            elif made_a is not None:
                before, a = made_a[0], made_a[2]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        if len(self.fits) > MAX_KEPT:
            self.fits.clear()
        got = self.fits[a << 32 | b] = self._stays_apart(a, b, float("inf"))
        return got

    def reachable(self, token: int) -> bool:
        """Whether the bytes of the token are encoded as this token."""
        got = self.whole.get(token)
        if got is None:
            made = self.parts.get(token)
            got = made is None or (self.reachable(made[1]) and self.reachable(made[2]) and self._stays_apart(made[1], made[2], made[0]))
            self.whole[token] = got
        return got

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """ids (little-endian, 32 bits) of distinct words, by the walk over their trie."""
        usable, fits, longest = self.usable.get, self.fits, self.longest
        out = {}
        last, size = [-1], [0]  # of the prefix of each length: its last token, that token's length
        before = b""
        for word, raw in sorted(((w, w.encode()) for w in words), key=lambda x: x[1]):
            shared, most = 0, min(len(before), len(raw))
            while shared < most and before[shared] == raw[shared]:
                shared += 1
            del last[shared + 1 :], size[shared + 1 :]
            for end in range(shared + 1, len(raw) + 1):
                for start in range(max(0, end - longest), end):
                    token = usable(raw[start:end])
                    if token is None:
                        continue
                    if start:
                        fit = fits.get(last[start] << 32 | token)
                        if not (self.compatible(last[start], token) if fit is None else fit):
                            continue
                    last.append(token)
                    size.append(end - start)
                    break
            found, at = [], len(raw)
            while at:
                found.append(last[at])
                at -= size[at]
            out[word] = np.array(found[::-1], "<u4").tobytes()
            before = raw
        return out

    def split(self, text: str) -> list[str]:
        """Words of a text, added tokens as words of their own."""
        wide = not text.isascii() and len(text.encode("utf-16-le")) > 2 * len(text)
        find = self.patterns[0x80 if text.isascii() else 0x110000 if wide else 0x10000].findall
        if self.cut is None or not self.cut.search(text):
            return find(text)
        out = []
        for i, part in enumerate(self.cut.split(text)):
            out += [part] if i % 2 else find(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        kept = self.kept
        if len(kept) > MAX_KEPT:
            kept.clear()
        kept.update((t, np.array([i], "<u4").tobytes()) for t, i in self.added.items())
        new = set().union(*split) - kept.keys()
        fresh = self.encode_words(list(new))
        long = {w: v for w, v in fresh.items() if len(w) > MAX_KEPT_LENGTH}
        kept.update(fresh)
        out = [b"".join([kept[w] for w in words]) for words in split]
        for w in long:
            del kept[w]
        return out

    def forget(self) -> None:
        """Drop what was kept of words and pairs."""
        self.kept.clear()
        self.fits.clear()

    def decode(self, ids: bytes) -> str:
        of = self.bytes
        return b"".join([of[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_loaded: dict[str, Model] = {}


def _model(shared: tuple[str, dict[str, list[int]]]) -> Model:
    key = hashlib.sha256(shared[0].encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Model(*shared)
    return _loaded[key]


_KINDS = {
    "ids": ("array<int>", pa.list_(pa.int32())),
    "n_tokens": ("bigint", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


def round_trip(df: DataFrame, tokenizer: str, keep: list[str], outputs: list[str], text: str = "text") -> DataFrame:
    """Per row, the columns ``keep`` and any of ``ids``, ``n_tokens``,
    ``ids_sha256``, ``decoded`` and ``decoded_sha256`` for the whole text.
    ``tokenizer`` is a file the driver can read; its content is broadcast (its
    size is that of the vocabulary, not of the data)."""
    with open(tokenizer, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast((f.read(), char_classes()))

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        model = _model(shared.value)

        def run(text: pa.Array) -> dict[str, pa.Array]:
            ids = model.encode([t or "" for t in text.to_pylist()])
            got: dict[str, list] = {
                "ids": [np.frombuffer(i, "<i4") for i in ids] if "ids" in outputs else [],
                "n_tokens": [len(i) // 4 for i in ids],
                "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
            }
            if "decoded" in outputs or "decoded_sha256" in outputs:
                got["decoded"] = [model.decode(i) for i in ids]
                got["decoded_sha256"] = [hashlib.sha256(t.encode()).hexdigest() for t in got["decoded"]]
            return {c: pa.array(got[c], _KINDS[c][1]) for c in outputs}

        run.close = model.forget
        return run

    return map_text(df, keep, make, ", ".join(f"{c} {_KINDS[c][0]}" for c in outputs), text)


def decode_ids(df: DataFrame, tokenizer: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text of an ``array<int>`` column; null ids give null."""
    with open(tokenizer, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast((f.read(), char_classes()))
    at = df.columns.index(ids)

    def run(batches):
        model = _model(shared.value)
        for batch in batches:
            texts = [None if i is None else model.decode(np.array(i, "<u4").tobytes()) for i in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(into, T.StringType())]))


TOKENIZER = "byte_bpe_50k.json"


def op6_encode(spark, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return round_trip(docs, public_tokenizers.path(TOKENIZER), ["doc_id"], ["n_tokens", "ids_sha256", "decoded_sha256"])
