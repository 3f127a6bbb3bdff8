"""Readers: comment dumps (plain and long-window zstd), lists, lexicon."""

import json
import os
import tempfile

import zstandard

from wordform.sources.comments import read_comments
from wordform.sources.lexicon import read_lexicon
from wordform.sources.lists import read_affixes, read_communities, read_vocab


def _dump_lines():
    rows = [
        {"id": "a1", "subreddit": "de", "body": "Hallo", "score": 3},
        {"id": "a2", "subreddit": "fr", "body": "Bonjour"},
    ]
    return [json.dumps(r) for r in rows] + ["{not json"]


def test_read_plain_ndjson(spark):
    d = tempfile.mkdtemp(prefix="wf-dump-")
    with open(os.path.join(d, "RC_2019-03"), "w") as fh:
        fh.write("\n".join(_dump_lines()) + "\n")
    got = read_comments(spark, d).orderBy("id").collect()
    ok = [r for r in got if not r.corrupt]
    assert [(r.id, r.subreddit, r.body, r.year, r.month) for r in ok] == [
        ("a1", "de", "Hallo", 2019, 3), ("a2", "fr", "Bonjour", 2019, 3)]
    assert sum(r.corrupt for r in got) == 1
    assert '"score": 3' in ok[0].raw


def test_stray_files_are_left_alone(spark):
    d = tempfile.mkdtemp(prefix="wf-stray-")
    for name, text in (("RC_2019-03", "\n".join(_dump_lines()[:2])), ("checksums.txt", "0 RC_2019-03"), ("RC_later", _dump_lines()[0])):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text + "\n")
    got = sorted((r.id, r.year or 0, r.month or 0) for r in read_comments(spark, d).collect())
    assert got == [("a1", 0, 0), ("a1", 2019, 3), ("a2", 2019, 3)]


def test_read_long_window_zstd(spark):
    d = tempfile.mkdtemp(prefix="wf-zst-")
    data = ("\n".join(_dump_lines()) + "\n").encode()
    params = zstandard.ZstdCompressionParameters.from_level(3, window_log=28)
    with open(os.path.join(d, "RC_2020-11.zst"), "wb") as fh:
        fh.write(zstandard.ZstdCompressor(compression_params=params).compress(data))
    got = read_comments(spark, d, long_window=True).collect()
    assert sorted((r.id, r.year, r.month) for r in got if not r.corrupt) == [("a1", 2020, 11), ("a2", 2020, 11)]


def test_lists(spark):
    d = tempfile.mkdtemp(prefix="wf-lists-")
    p, s, c, v = (os.path.join(d, n) for n in ("p.txt", "s.txt", "c.txt", "v.txt"))
    open(p, "w").write("un-\nver-\nun-\nprä-\n")
    open(s, "w").write("-ung\n-heit\n-ös\n")
    open(c, "w").write("de\n de \nFinanzen\n")
    open(v, "w").write("haus\nhaus\nbaum\n")
    aff = sorted((r.affix, r.kind) for r in read_affixes(spark, p, s).collect())
    assert aff == [("heit", "suffix"), ("prä", "prefix"), ("un", "prefix"), ("ung", "suffix"), ("ver", "prefix"), ("ös", "suffix")]
    assert sorted(r.subreddit for r in read_communities(spark, c).collect()) == ["Finanzen", "de"]
    assert sorted(r.token for r in read_vocab(spark, v).collect()) == ["baum", "haus"]


def test_lexicon_cleaning_last_wins(spark):
    d = tempfile.mkdtemp(prefix="wf-lex-")
    p = os.path.join(d, "lex.tsv")
    lines = [
        "Haus\tHaus\tNN\t10",
        "haus\thausen\tVVINF\t5",  # same lower-case word, later line wins
        "der\tdie\tART\t100",
        "foo\tunknown\tNN\t3",  # dropped: base unknown
        "bar\tBar\t$(\t3",  # dropped: POS with $
        "baz\tBaz\tNN\t",  # dropped: no frequency
    ]
    open(p, "w").write("\n".join(lines) + "\n")
    got = {r.word: (r.base, r.pos) for r in read_lexicon(spark, p).collect()}
    assert got == {"haus": ("hausen", "VVINF"), "der": ("die", "ART")}


def test_read_selected_months_skips_missing(spark):
    d = tempfile.mkdtemp(prefix="wf-months-")
    for name in ("RC_2019-03", "RC_2019-04"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write("\n".join(_dump_lines()[:2]) + "\n")
    got = read_comments(spark, d, months=[(2019, 4), (2019, 5)]).collect()
    assert {(r.year, r.month) for r in got} == {(2019, 4)} and len(got) == 2
    assert read_comments(spark, d, months=[(2020, 1)]).count() == 0


def test_failfast_raises_on_malformed_line(spark):
    import pytest

    d = tempfile.mkdtemp(prefix="wf-ff-")
    with open(os.path.join(d, "RC_2019-05"), "w") as fh:
        fh.write("\n".join(_dump_lines()) + "\n")
    with pytest.raises(Exception):
        read_comments(spark, d, failfast=True).collect()


def test_line_status_tells_lines_apart(spark):
    from pyspark.sql import functions as F

    from wordform.sources.comments import line_status

    lines = {
        '{"id": 1, "body": "x", "new field": [1, {"a": null}]}': "comment", '{"body": ""}': "comment", '{"body": 5}': "comment",
        '{"body": null}': "null_body", '{"id": "a"}': "no_body", "{}": "no_body", "[1]": "no_object", '"text"': "no_object", "null": "no_object",
        "{broken": "not_json", "not json 1": "not_json",
    }
    rows = spark.createDataFrame([(x,) for x in lines], "raw string").select("raw", line_status(F.col("raw")).alias("s")).collect()
    assert {r.raw: r.s for r in rows} == lines
