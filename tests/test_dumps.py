"""The dump data source: frames, splits, pushed filters."""

import json
import os
import random
import tempfile

import pytest
import zstandard

from wordform.sources import dumps
from wordform.sources.comments import read_comments
from wordform.sources.dumps import frames, scan_dumps


def _lines(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        body = rng.choice([None, "", "ä" * rng.randrange(1, 400), 'quote " and \\ and 😀', "x" * rng.choice([10, 70_000])])
        out.append(json.dumps({"id": str(i), "subreddit": rng.choice("abc"), "body": body, "more": [1, {"z": i}]}, ensure_ascii=bool(i % 2)))
        if i % 9 == 0:
            out.append(rng.choice(["{broken", "", "[1]", '"text"', "null", '{"id": "no body"}']))
    return out


def _write(path, lines, per_frame=None, window_log=None, skippable=False):
    data = ("\n".join(lines) + "\n").encode()
    if not path.endswith(".zst"):
        with open(path, "wb") as fh:
            fh.write(data)
        return
    rng = random.Random(1)
    params = zstandard.ZstdCompressionParameters.from_level(3, window_log=window_log) if window_log else zstandard.ZstdCompressionParameters.from_level(3, write_checksum=1)
    with open(path, "wb") as fh:
        at = 0
        while at < len(data):
            step = rng.randrange(1, 2 * per_frame) if per_frame else len(data)
            fh.write(zstandard.ZstdCompressor(compression_params=params).compress(data[at : at + step]))  # cuts lines and characters
            if skippable:
                fh.write((0x184D2A53).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"index")
            at += step


def _rows(df):
    return sorted(map(str, df.select("id", "subreddit", "body", "raw", "year", "month", "corrupt").collect()))


@pytest.mark.parametrize("skippable", [False, True])
def test_frames_cut_anywhere_give_the_same_lines(spark, skippable):
    d = tempfile.mkdtemp(prefix="wf-dumps-")
    os.mkdir(f"{d}/frames")
    os.mkdir(f"{d}/plain")
    for m in (1, 2):
        _write(f"{d}/frames/RC_2020-0{m}.zst", _lines(120, m), per_frame=9_000, skippable=skippable)
        _write(f"{d}/plain/RC_2020-0{m}", _lines(120, m))
    with open(f"{d}/plain/notes.txt", "w") as fh:
        fh.write("0 RC_2020-01\n")
    want = _rows(read_comments(spark, f"{d}/plain").where("raw <> ''"))
    for split in (1, 3000, 1 << 30):
        df = scan_dumps(spark, f"{d}/frames", split_bytes=split)
        assert _rows(df.where("raw <> ''")) == want
        if split == 1:
            assert df.rdd.getNumPartitions() > 20  # several tasks for a file of several frames
    for split in (777, 1 << 30):
        assert _rows(scan_dumps(spark, f"{d}/plain", split_bytes=split).where("raw <> ''")) == want
    assert _rows(scan_dumps(spark, f"{d}/plain/RC_2020-01").where("raw <> ''")) == [r for r in want if "month=1," in r]


def test_frame_walk_equals_what_was_written():
    d = tempfile.mkdtemp(prefix="wf-dumps-")
    _write(f"{d}/RC_2020-01.zst", ["a" * 300_000] + _lines(50), per_frame=100_000, skippable=True)
    size = os.path.getsize(f"{d}/RC_2020-01.zst")
    with open(f"{d}/RC_2020-01.zst", "rb") as fh:
        found = list(frames(fh, size))
        assert found[0][0] == 0 and size == found[-1][1] + 13
        text = b""
        for a, b in found:
            fh.seek(a)
            text += zstandard.ZstdDecompressor().decompressobj().decompress(fh.read(b - a))
        assert text.startswith(b"a" * 300_000 + b"\n{")
        with pytest.raises(ValueError):
            list(frames(open(__file__, "rb"), 100))


def test_long_windows(spark):
    d = tempfile.mkdtemp(prefix="wf-dumps-")
    _write(f"{d}/RC_2021-01.zst", _lines(40), window_log=30)
    assert scan_dumps(spark, d).where("not corrupt").count() > 10


def test_filters_reach_the_reader(spark):
    d = tempfile.mkdtemp(prefix="wf-dumps-")
    for y, m in ((2019, 12), (2020, 1), (2020, 2)):
        _write(f"{d}/RC_{y}-{m:02d}", _lines(30, m))
    everything = scan_dumps(spark, d)
    some = scan_dumps(spark, d, months=[(2020, 1), (2019, 12)], communities=["a", "c", "nobody's"])
    want = everything.where("((year = 2020 and month = 1) or (year = 2019 and month = 12)) and subreddit in ('a', 'c')")
    assert _rows(some) == _rows(want) != []
    plan = some._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and all(c in pushed[0] for c in ("year", "month", "subreddit")), plan
    assert everything.where("month > 1 and year <= 2019").rdd.getNumPartitions() == 1
    assert scan_dumps(spark, d, months=[]).count() == 0
    assert scan_dumps(spark, d, communities=[]).count() == 0


def test_failfast(spark):
    d = tempfile.mkdtemp(prefix="wf-dumps-")
    _write(f"{d}/RC_2021-01", ['{"id": 1, "body": 2}', "nonsense"])
    assert [(r.id, r.body, r.corrupt) for r in scan_dumps(spark, d).orderBy("corrupt").collect()] == [("1", "2", False), (None, None, True)]
    with pytest.raises(Exception, match="malformed comment"):
        scan_dumps(spark, d, failfast=True).collect()


def test_empty(spark):
    d = tempfile.mkdtemp(prefix="wf-dumps-")
    assert scan_dumps(spark, d).count() == 0
    _write(f"{d}/RC_2021-01", [""])
    assert scan_dumps(spark, d).where("raw <> ''").count() == 0
    assert dumps.SCHEMA.startswith("id string")


def test_small_ranges_share_tasks_and_read_little_past_their_end(spark, tmp_path, monkeypatch):
    lines = [json.dumps({"id": str(i), "subreddit": "a", "body": "x" * (i % 90)}) for i in range(20_000)]
    for m in (1, 2):
        _write(f"{tmp_path}/RC_2020-0{m}", lines[: 10_000 * m])
    reader = dumps.DumpReader({"path": str(tmp_path), "splitbytes": "700"})
    tasks = reader.partitions()
    ranges = [r for t in tasks for r in t.ranges]
    assert len(ranges) > 3000 and dumps.TASKS // 2 <= len(tasks) <= 2 * dumps.TASKS
    assert [(r.path, r.start) for r in ranges] == sorted((r.path, r.start) for r in ranges) and max(r.end - r.start for r in ranges) == 700
    assert sum(r.end - r.start for r in ranges) == sum(os.path.getsize(f"{tmp_path}/RC_2020-0{m}") for m in (1, 2))
    assert [r for t in tasks for b in reader.read(t) for r in b.column(0).to_pylist()] == [str(i) for m in (1, 2) for i in range(10_000 * m)]
    with open(f"{tmp_path}/RC_2020-02", "rb") as fh:
        read = sum(len(data) for data, _ in list(dumps._plain(fh, ranges[-100]))[:2])
    assert read <= 700 + dumps.TAIL_BYTES
    assert _rows(scan_dumps(spark, str(tmp_path), split_bytes=700)) == _rows(scan_dumps(spark, str(tmp_path)))
    assert len(dumps._tasks([dumps.DumpRange("a", 1, 1, i << 26, (i + 1) << 26) for i in range(1000)])) == 1000  # large ranges stay alone
    assert dumps._tasks([]) == []
