"""License scan: TF-IDF cosine to templates, then inheritance along paths.

Every line of a text (a long one in overlapping windows of ``WINDOW`` words) is a
sparse TF-IDF vector; its licence is the template with the largest cosine of at
least ``least``. Document frequencies are counted over all texts, per hash
bucket of words, so any word has one. A line is only scored if the templates'
terms in it could reach ``least``: by Cauchy and Schwarz the cosine is at most
the share of the template's norm on the shared terms.

With ``stretches``, notices within longer lines and over line ends count too:
from every template term, the stretches of the text that end at another and are
at most as long as the template and ``slack`` words more are scored by their own
cosine, whatever stands before and after them. A stretch holds at least half of
the template's terms, and ``FEW`` of them or all. Candidates come from exact
counts of distinct terms per pair of neighbouring blocks of that length. Headers
(``HEADERS``) are found in the same way, and every whole text is scored against
the texts of licences in ``data/licenses``, by the same bound; the best of these
two decides over lines and notices from ``HEADER_LEAST`` and ``WHOLE_LEAST``.

A file's own licence is its best line's, the first of equal ones (empty lines do not
count). Files with a licence in
their first ``HEADER_LINES`` lines, and files named like one, speak for their
directory; of several the best, then that with the smallest path counts. A file
without a licence inherits that of the nearest ancestor directory that has one:
its ancestors are exploded and joined with the directories by path.

Null and empty texts have no licence of their own. A null path has no directory
and inherits nothing. Repeated rows are judged one by one. Ties between
templates go to the first name. Empty tables give no rows. Other columns are not
read."""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordform.llm.common import ALNUM, Words, byte_table, map_arrow, map_text, table, text_buffer, text_ranges, written

WINDOW = 32
LEAST = 0.5
#: Cosines from which a header or a whole text decides over single lines.
HEADER_LEAST, WHOLE_LEAST = 0.7, 0.8
LICENSE_TEXTS = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "data", "licenses")
#: Distinct terms of a template (all of a smaller one) that a stretch of running text holds at least.
FEW = 4
BITS = 18
_MASK = np.uint64((1 << BITS) - 1)
_LINE = byte_table(lambda b: b != 0x0A)
MAX_BROADCAST_DIRECTORIES = 500_000
#: A licence within so many lines from the top speaks for the directory.
HEADER_LINES = 3

# Notices by which common licences are named in headers and files.
TEMPLATES = [
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "To the extent possible under law, all copyright and related rights are waived under CC0 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "All rights reserved"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]
_GNU = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} License"
    " as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version"
)
# What the headers of files say.
HEADERS = [
    ("AGPL-3.0", _GNU.format("program", "Affero General Public", "3")),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("GPL-2.0", _GNU.format("program", "General Public", "2")),
    ("GPL-3.0", _GNU.format("program", "General Public", "3")),
    ("LGPL-2.1", _GNU.format("library", "Lesser General Public", "2.1")),
    ("LGPL-3.0", _GNU.format("library", "Lesser General Public", "3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
]
LICENSE_NAMES = "(?i)^(licen[cs]e|copying|notice)([._-].*)?$"


def bucket_frequencies(df: DataFrame) -> tuple[np.ndarray, int]:
    """(texts that hold a word of each bucket, texts) over all rows (text in ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros((1 << BITS) + 1, np.int64), 0
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            n += batch.num_rows
            for a, b in text_ranges(offsets):
                w = Words(data, offsets[a : b + 1], ALNUM)
                doc = np.repeat(np.arange(b - a, dtype=np.int64), np.diff(w.ptr))
                pair = np.unique((doc << BITS) | (w.hashes() & _MASK).astype(np.int64))
                counts += np.bincount(pair & int(_MASK), minlength=(1 << BITS) + 1)
        counts[-1] = n
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(counts[full], pa.int64())], names=["bucket", "n"])

    rows = map_arrow(df.select("text"), run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((1 << BITS) + 1, np.int64)
    counts[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts[:-1], int(counts[-1])


def license_texts() -> list[tuple[str, str]]:
    """(licence, its whole text), from the files in ``LICENSE_TEXTS``."""
    out = []
    for name in sorted(os.listdir(LICENSE_TEXTS)):
        with open(os.path.join(LICENSE_TEXTS, name), encoding="utf-8") as f:
            out.append((name.removesuffix(".txt"), f.read()))
    return out


def slack(length: int) -> int:
    """Words that may stand between those of a notice of ``length`` words."""
    return max(FEW, length // 4)


def _hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return Words(raw, np.array([0, len(raw)]), ALNUM).hashes()


class Matcher:
    """Templates as sparse unit vectors over their terms (word hashes)."""

    def __init__(self, templates: list[tuple[str, str]], counts: np.ndarray, n: int, least: float):
        self.idf = np.log((1 + n) / (1 + counts)) + 1
        self.least = least
        self.headers: Matcher | None = None
        self.whole: Matcher | None = None
        templates = sorted(templates)
        self.names = [name for name, _ in templates]
        hashed = [_hashes(text) for _, text in templates]
        self.terms = np.unique(np.concatenate(hashed))
        self.vectors = np.zeros((len(self.terms), len(templates)))
        for t, h in enumerate(hashed):
            term, tf = np.unique(h, return_counts=True)
            v = tf * self._weight(term)
            self.vectors[np.searchsorted(self.terms, term), t] = v / math.sqrt((v * v).sum())
        self.lengths = [len(h) for h in hashed]
        self.bits = np.zeros(1 << 16, dtype=bool)
        self.bits[(self.terms & np.uint64(0xFFFF)).astype(np.int64)] = True

    def with_blocks(self, headers: Matcher, whole: Matcher) -> Matcher:
        """Look for headers and whole texts too."""
        headers.idf = whole.idf = self.idf
        self.headers, self.whole = headers, whole
        return self

    def _weight(self, h: np.ndarray) -> np.ndarray:
        return self.idf[(h & _MASK).astype(np.int64)]

    def best(self, h: np.ndarray) -> tuple[float, int]:
        """Largest cosine of a line (its word hashes) and its template."""
        term, tf = np.unique(h, return_counts=True)
        v = tf * self._weight(term)
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        own = self.terms[at] == term
        cosines = v[own] @ self.vectors[at[own]] / math.sqrt((v * v).sum())
        t = int(cosines.argmax())
        return float(cosines[t]), t

    def found(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words that are template terms, and their terms."""
        at = np.flatnonzero(self.bits[(h & np.uint64(0xFFFF)).astype(np.int64)])
        term = np.minimum(np.searchsorted(self.terms, h[at]), len(self.terms) - 1)
        hit = self.terms[term] == h[at]
        return at[hit], term[hit]

    def likely(self, which: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Those of ``which`` (sorted, each term once) whose terms hold enough of a template's norm."""
        some, first = np.unique(which, return_index=True)
        held = np.add.reduceat(self.vectors[term] ** 2, first, axis=0)
        return some[held.max(axis=1) >= self.least**2 * (1 - 1e-9)]

    def stretches(self, h: np.ndarray, at: np.ndarray, term: np.ndarray, stop: np.ndarray) -> Iterator[tuple[int, float, int]]:
        """(first word, cosine, template) of the best stretch from each word
        ``at`` that is a template's ``term`` and has enough of its terms after
        it, before the word ``stop``."""
        for t, length in enumerate(self.lengths):
            mine = self.vectors[term, t] > 0
            p, e, x = at[mine], stop[mine], term[mine]
            m = int((self.vectors[:, t] > 0).sum())
            need = min(m, max(FEW, -(-m // 2)))
            reach = length + slack(length)
            # a stretch lies in two neighbouring blocks: each term of a block counts for it and the one before
            block = p // reach
            pair = np.unique(np.concatenate([block, np.maximum(block - 1, 0)]) * len(self.terms) + np.concatenate([x, x]))
            full, n = np.unique(pair // len(self.terms), return_counts=True)
            full = full[n >= need]
            if not len(full):
                continue
            found = full[np.minimum(np.searchsorted(full, block), len(full) - 1)] == block
            own = dict(zip(self.terms.tolist(), self.vectors[:, t].tolist()))
            for a, end in zip(p[found].tolist(), np.minimum(p + reach, e)[found].tolist()):
                words = h[a:end]
                tf: dict[int, int] = {}
                dot = norm = best = 0.0
                held = 0
                for word, w in zip(words.tolist(), self._weight(words).tolist()):
                    k = tf.get(word, 0)
                    tf[word] = k + 1
                    norm += w * w * (2 * k + 1)
                    v = own.get(word, 0.0)
                    if v:
                        dot += w * v
                        held += k == 0
                        if held >= need:
                            best = max(best, dot / math.sqrt(norm))
                if best >= self.least:
                    yield a, best, t

    def match(self, data: np.ndarray, offsets: np.ndarray, stretches: bool = False) -> list[tuple[str | None, float, int | None]]:
        """Per text: licence, cosine and line number of its best line, or of its best header, whole text or stretch."""
        w = Words(data, offsets, ALNUM)
        lines = Words(data, offsets, _LINE)
        h = w.hashes()
        out: list[tuple[str | None, float, int | None]] = [(None, 0.0, None)] * (len(offsets) - 1)
        at, term = self.found(h)
        if not len(at):
            return out
        all_terms = term
        line = np.searchsorted(lines.starts, w.starts[at], side="right") - 1
        # lines whose shared terms hold enough of a template's norm, each term once
        pair = np.unique(line * len(self.terms) + term)
        which, term = np.divmod(pair, len(self.terms))
        some = self.likely(which, term)
        words_of = np.searchsorted(w.starts, np.stack([lines.starts[some], lines.ends[some]]))
        doc = np.searchsorted(lines.ptr, some, side="right") - 1
        for k, d, a, b in zip(some.tolist(), doc.tolist(), words_of[0].tolist(), words_of[1].tolist()):
            for x in range(a, max(b - WINDOW // 2, a + 1), WINDOW // 2):
                score, t = self.best(h[x : min(x + WINDOW, b)])
                if score >= self.least and score > out[d][1] + 1e-12:
                    out[d] = (self.names[t], score, k - int(lines.ptr[d]))
        if not stretches:
            return out

        def place(a: int) -> tuple[int, int]:
            """Text and line of a word."""
            k = int(np.searchsorted(lines.starts, w.starts[a], side="right")) - 1
            d = int(np.searchsorted(lines.ptr, k, side="right")) - 1
            return d, k - int(lines.ptr[d])

        def better(new: tuple[str, float, int], old: tuple[str | None, float, int | None]) -> bool:
            return old[0] is None or new[1] > old[1] + 1e-12 or (new[1] > old[1] - 1e-12 and new[2] < old[2])

        stop = lambda at: w.ptr[np.searchsorted(w.ptr, at, side="right")]
        for a, score, t in self.stretches(h, at, all_terms, stop(at)):
            d, k = place(a)
            if better((self.names[t], score, k), out[d]):
                out[d] = (self.names[t], score, k)
        if self.headers is None:
            return out
        # headers and whole texts: the best of these decides over lines
        blocks: dict[int, tuple[str, float, int]] = {}
        at, term = self.headers.found(h)
        for a, score, t in self.headers.stretches(h, at, term, stop(at)) if len(at) else ():
            d, k = place(a)
            if better((self.headers.names[t], score, k), blocks.get(d, (None, 0.0, None))):
                blocks[d] = (self.headers.names[t], score, k)
        at, term = self.whole.found(h)
        pair = np.unique((np.searchsorted(w.ptr, at, side="right") - 1) * len(self.whole.terms) + term)
        for d in self.whole.likely(*np.divmod(pair, len(self.whole.terms))).tolist() if len(pair) else ():
            score, t = self.whole.best(h[w.ptr[d] : w.ptr[d + 1]])
            if score >= self.whole.least and score > blocks.get(d, (None, 0.0, None))[1] + 1e-12:
                blocks[d] = (self.whole.names[t], score, 0)
        for d, found in blocks.items():
            out[d] = found
        return out


def own_licenses(files: DataFrame, templates: list[tuple[str, str]], least: float = LEAST, stretches: bool = False) -> DataFrame:
    """(row, path, license, score, line) of each row of ``files`` (row, path, text)."""
    counts, n = bucket_frequencies(files)
    matcher = Matcher(templates, counts, n, least)
    if stretches:
        matcher = matcher.with_blocks(Matcher(HEADERS, counts, n, HEADER_LEAST), Matcher(license_texts(), counts, n, WHOLE_LEAST))
    shared = files.sparkSession.sparkContext.broadcast(matcher)

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        def run(texts: pa.Array) -> dict[str, pa.Array]:
            found = shared.value.match(*text_buffer(texts), stretches)
            return {
                "license": pa.array([x[0] for x in found], pa.string()),
                "score": pa.array([x[1] for x in found], pa.float64()),
                "line": pa.array([x[2] for x in found], pa.int64()),
            }

        return run

    return map_text(files, ["row", "path"], make, "license string, score double, line bigint")


def _directory(path: Column) -> Column:
    """Everything before the last slash; null at the top."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", ""))


def inherit(own: DataFrame) -> DataFrame:
    """``own`` (row, path, license, score, line) with ``origin`` (own, inherited or
    none), the licence in force and ``from_path``, the file it comes from."""
    name = F.regexp_extract("path", "[^/]*$", 0)
    sources = own.where(F.col("license").isNotNull() & F.col("path").isNotNull() & ((F.col("line") < HEADER_LINES) | name.rlike(LICENSE_NAMES)))
    best = F.struct((-F.col("score")).alias("s"), "path", "license", "score")
    directories = written(
        sources.withColumn("directory", _directory(F.col("path")))
        .where("directory is not null")
        .groupBy("directory")
        .agg(F.min(best).alias("b"))
        .select("directory", F.col("b.license").alias("d_license"), F.col("b.score").alias("d_score"), F.col("b.path").alias("d_path")),
        "directories",
    )
    if directories.count() <= MAX_BROADCAST_DIRECTORIES:
        directories = F.broadcast(directories)
    # the ancestors of a file: its path cut at each of its slashes
    parts = F.split("path", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("directory")))
    bare = own.where("license is null and path is not null and instr(path, '/') > 0")
    nearest = (
        bare.select("row", F.explode(ancestors).alias("a"))
        .select("row", "a.depth", "a.directory")
        .join(directories, "directory")
        .groupBy("row")
        .agg(F.max(F.struct("depth", "d_license", "d_score", "d_path")).alias("n"))
    )
    given = own.join(nearest, "row", "left")
    return given.select(
        "row",
        "path",
        F.coalesce("license", "n.d_license").alias("license"),
        F.when(F.col("license").isNotNull(), F.col("score")).otherwise(F.coalesce("n.d_score", F.lit(0.0))).alias("score"),
        "line",
        F.when(F.col("license").isNotNull(), "own").when(F.col("n").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("license").isNotNull(), F.col("path")).otherwise(F.col("n.d_path")).alias("from_path"),
    )


def scan(files: DataFrame, path: str | Column = "path", text: str = "text", keep: list[str] | None = None, templates: list[tuple[str, str]] | None = None, least: float = LEAST, stretches: bool = False) -> DataFrame:
    """Per row of ``files``: the columns ``keep``, path, license (in force),
    score, line (of the own one), origin and from_path. ``stretches`` looks
    within longer lines, over line ends, at headers and at whole texts too;
    without it only lines and their windows count."""
    where = F.col(path) if isinstance(path, str) else path
    kept = F.struct(*[F.col(c) for c in keep or []]) if keep else F.struct(F.lit(None).alias("none"))
    rows = files.select(kept.alias("kept"), where.cast("string").alias("path"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # a row's name must hold between the scans: it goes with what is written first
    own = own_licenses(rows.select(F.struct("kept", F.monotonically_increasing_id().alias("id")).alias("row"), "path", "text"), templates or TEMPLATES, least, stretches)
    own = written(own.select(F.col("row.id").alias("row"), F.col("row.kept").alias("kept"), "path", "license", "score", "line"), "licenses")
    found = inherit(own.drop("kept"))
    return own.select("row", "kept").join(found, "row").select(*[F.col(f"kept.`{c}`").alias(c) for c in keep or []], "path", "license", "score", "line", "origin", "from_path")


def op7_licenses(spark, sf_dir: str) -> DataFrame:
    """The licence of every document. Documents lie in a tree of directories:
    source, language, then the digits of the id, the last of which names the file."""
    docs = table(spark, sf_dir, "documents")
    digits = F.array_join(F.split(F.col("doc_id").cast("string"), ""), "/")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), digits)
    return scan(docs, F.when(F.col("doc_id").isNotNull(), path), keep=["doc_id"], stretches=True)
