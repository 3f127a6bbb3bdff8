import base64
import gzip
import hashlib

import pytest

from wordform.llm.common import scratch_path
from wordform.llm.warc import OP2_SQL, arc_begin, arc_record, arc_records, convert, http_parts, iso_time, op2_archives, read_warc, warc_record, warc_records, write_arc


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def save(path, *members):
    path.write_bytes(b"".join(gzip.compress(m) for m in members))
    return str(path)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_by_version_and_length(tmp_path, version):
    blocks = [b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\n\nwith lines\n", b"", b"\n\nfiledesc://x 1 2 3 4\n"]
    members = [arc_begin("x.arc.gz", version, "20010203040506")] + [arc_record(version, "x.arc.gz", f"http://e.org/a b{i}", "2001", b) for i, b in enumerate(blocks)]
    got = list(arc_records(save(tmp_path / "x.arc.gz", *members)))
    assert [b for _, b in got] == blocks
    assert got[0][0]["URL"] == "http://e.org/a%20b0" and got[0][0]["Archive-date"] == "2001"
    assert ("Checksum" in got[0][0]) == (version == 2)


def test_broken_archives_are_told(tmp_path):
    with pytest.raises(ValueError, match="before a declared length"):
        list(arc_records(save(tmp_path / "a", arc_begin("a", 1, "2001"), b"http://e.org/ 0.0.0.0 2001 text/html 99\nshort")))
    with pytest.raises(ValueError, match="no version block"):
        list(arc_records(save(tmp_path / "b", b"http://e.org/ 0.0.0.0 2001 text/html 0\n")))
    with pytest.raises(ValueError, match="fields"):
        list(arc_records(save(tmp_path / "c", arc_begin("c", 2, "2001"), b"http://e.org/ 0.0.0.0 2001 text/html 0\n\n")))


def test_small_parts(tmp_path):
    assert iso_time("20010203040506") == "2001-02-03T04:05:06Z" and iso_time("2001") == "2001-01-01T00:00:00Z" and iso_time("x") == "1970-01-01T00:00:00Z"
    assert http_parts(b"HTTP/1.0 200 OK\r\nA: b: c\r\n\r\nx") == ({"a": "b: c"}, b"HTTP/1.0 200 OK\r\nA: b: c\r\n\r\n", b"x")
    assert http_parts(b"plain") == ({}, b"", b"plain")
    path = save(tmp_path / "w", warc_record([("WARC-Type", "resource")], b"\r\n\r\nWARC/1.0"), warc_record([("WARC-Type", "x")], b""))
    assert [(f["WARC-Type"], b) for f, b in warc_records(path)] == [("resource", b"\r\n\r\nWARC/1.0"), ("x", b"")]


def test_round_trip(spark):
    long = "<p>é</p>" * 30000
    pages = [(5, "http://e.org/1", "same"), (3, "u v\n", "same"), (9, None, None), (4, "", ""), (None, "http://n", "same"), (7, "x", long), (8, "x", long), (8, "x", long), (6, "y", "alone")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, payload_digest string").repartition(3)
    manifest = convert(write_arc(df, scratch_path(spark, "a")), scratch_path(spark, "w"))
    rows = read_warc(manifest).collect()
    assert len(rows) == len(pages) and len({r["record_id"] for r in rows}) == len(pages)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)
    least = {"same": 3, "": 4, long: 7, "alone": 6}
    want = [(p, len((h or "").encode()), sha((h or "").encode()), "response" if p == least[h or ""] else "revisit", None if p == least[h or ""] else least[h or ""]) for p, _, h in pages]
    assert got == sorted(want, key=str)
    by = {r["record_id"]: r for r in rows}
    for r in rows:
        if r["record_type"] == "revisit":
            assert by[r["refers_to_id"]]["page_id"] == r["refers_to"] and r["payload"] is None
        else:
            assert sha(bytes(r["payload"])) == r["payload_digest"]
    few = read_warc(convert(write_arc(df, scratch_path(spark, "a")), scratch_path(spark, "w"), min_bytes=5)).collect()
    assert sum(r["record_type"] == "revisit" for r in few) == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_warc(convert(write_arc(df, scratch_path(spark, "a")), scratch_path(spark, "w"))).count() == 0


def test_query_equals_sql(oracle):
    oracle(op2_archives, OP2_SQL)
