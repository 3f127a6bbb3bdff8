"""Comment dumps as a Spark data source: ``spark.read.format("comment_dumps")``.

A dump (``RC_YYYY-MM``, plain NDJSON, or ``.zst`` with any window up to 2 GiB) is
read by many tasks: a plain file in byte ranges, a compressed one in ranges of zstd
frames, which are found by walking the block headers (three bytes of every 128 KB)
without decompressing anything. A line belongs to the range in which it begins: a range
skips what is left of the line before it and reads its last line to the end, also
into the next frames. Small ranges share tasks once there are many of them.

Filters on ``year`` and ``month`` choose files before any is opened, those on
``subreddit`` drop comments before their rows are built; Spark shows both as pushed.
Files are opened through pyarrow filesystems (local, HDFS, object stores). Memory
of a task: the window that the file asks for, and batches of a few MB.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

SCHEMA = "id string, subreddit string, body string, raw string, year int, month int, corrupt boolean"
NAME = "comment_dumps"
FILE_RE = re.compile(r"RC_(\d{4})-(\d{2})")
ZSTD_MAX_WINDOW = 2**31
#: Compressed (or plain) bytes that a task takes at least, if the file has as many.
SPLIT_BYTES = 64 << 20
#: Ranges are read together, in one task, up to so many bytes and as long as there
#: are so many tasks: the cost of a task is not paid for every small range.
TASK_BYTES, TASKS = 16 << 20, 256
READ_BYTES = 1 << 20
#: What is read first for the end of a range's last line; twice as much each time after.
TAIL_BYTES = 4 << 10
BATCH_ROWS, BATCH_BYTES = 10_000, 4 << 20

# Fixed values of the zstd frame format.
FRAME_MAGIC = 0xFD2FB528
SKIPPABLE_MAGIC, SKIPPABLE_MASK = 0x184D2A50, 0xFFFFFFF0
DICTIONARY_ID_BYTES = (0, 1, 2, 4)
CONTENT_SIZE_BYTES = (0, 2, 4, 8)
RLE_BLOCK = 1


def _open(uri: str):
    from pyarrow import fs as pafs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


def frames(fh, size: int) -> Iterator[tuple[int, int]]:
    """(start, end) of every frame that holds data."""
    at = 0

    def number(offset: int, n: int) -> int:
        fh.seek(offset)
        return int.from_bytes(fh.read(n), "little")

    while at < size:
        start, magic = at, number(at, 4)
        if magic & SKIPPABLE_MASK == SKIPPABLE_MAGIC:
            at += 8 + number(at + 4, 4)
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no zstd frame at byte {at}")
        descriptor = number(at + 4, 1)
        single, checksum = descriptor >> 5 & 1, descriptor >> 2 & 1
        content = CONTENT_SIZE_BYTES[descriptor >> 6] or single
        at += 5 + (0 if single else 1) + DICTIONARY_ID_BYTES[descriptor & 3] + content
        last = False
        while not last:
            header = number(at, 3)
            last, kind, length = bool(header & 1), header >> 1 & 3, header >> 3
            at += 3 + (1 if kind == RLE_BLOCK else length)
        at += 4 * checksum
        yield start, at


@dataclass
class DumpRange:
    path: str
    year: int | None
    month: int | None
    start: int
    end: int


@dataclass
class DumpTask(InputPartition):
    ranges: list[DumpRange]


def _tasks(ranges: list[DumpRange]) -> list[DumpTask]:
    """Consecutive ranges dealt into tasks."""
    share = min(TASK_BYTES, sum(r.end - r.start for r in ranges) // TASKS)
    tasks: list[DumpTask] = []
    size = share
    for r in ranges:
        if size + r.end - r.start > share:
            tasks.append(DumpTask([]))
            size = 0
        tasks[-1].ranges.append(r)
        size += r.end - r.start
    return tasks


def _ranges(path: str, year: int | None, month: int | None, size: int, split: int) -> Iterator[DumpRange]:
    if not path.endswith(".zst"):
        for start in range(0, size, split):
            yield DumpRange(path, year, month, start, min(start + split, size))
        return
    filesystem, inner = _open(path)
    if size <= split:  # one task anyway
        yield DumpRange(path, year, month, 0, size)
        return
    with filesystem.open_input_file(inner) as fh:
        begin, end = 0, 0
        for _, end in frames(fh, size):
            if end - begin >= split:
                yield DumpRange(path, year, month, begin, end)
                begin = end
        if end > begin:
            yield DumpRange(path, year, month, begin, end)


def _plain(fh, part: DumpRange) -> Iterator[tuple[bytes, bool]]:
    at, tail = part.start, TAIL_BYTES
    fh.seek(at)
    while data := fh.read(tail if at >= part.end else min(READ_BYTES, part.end - at)):
        if at >= part.end:
            tail = min(2 * tail, READ_BYTES)
        yield data, at < part.end
        at += len(data)


def _decompressed(fh, part: DumpRange) -> Iterator[tuple[bytes, bool]]:
    """(bytes, whether their frame begins in the range) from the range's start on."""
    import zstandard

    fh.seek(part.start)
    at, data = part.start, b""
    while True:
        while len(data) < 8 and (more := fh.read(READ_BYTES)):
            data += more
        if not data:
            return
        if int.from_bytes(data[:4], "little") & SKIPPABLE_MASK == SKIPPABLE_MAGIC:
            at += 8 + int.from_bytes(data[4:8], "little")
            fh.seek(at)
            data = b""
            continue
        inside, frame = at < part.end, zstandard.ZstdDecompressor(max_window_size=ZSTD_MAX_WINDOW).decompressobj()
        while not frame.eof:
            at += len(data)
            out = frame.decompress(data)
            if out:
                yield out, inside
            if not frame.eof and not (data := fh.read(READ_BYTES)):
                return  # a file that is cut off ends where it ends
        data = frame.unused_data
        at -= len(data)


def lines_of(pieces: Iterator[tuple[bytes, bool]], first: bool) -> Iterator[bytes]:
    """Lines that begin in the range, given its bytes and those after it."""
    rest, skip = b"", not first
    for data, inside in pieces:
        if not inside:
            # the line that the range's end cuts, or that begins right after it
            head, newline, _ = data.partition(b"\n")
            rest += head
            if not newline:
                continue
            break
        if skip:
            _, newline, data = data.partition(b"\n")
            if not newline:
                continue
            skip = False
        *whole, rest = (rest + data).split(b"\n")
        yield from whole
    if rest and not skip:
        yield rest


class DumpReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.failfast = options.get("failfast", "false").lower() == "true"
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.file_tests: list[tuple[str, type, object]] = []
        self.communities: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", (None,))[0]
            if column in ("year", "month") and isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                self.file_tests.append((column, type(f), f.value))
            elif column == "subreddit" and isinstance(f, (EqualTo, In)):
                names = set(f.value) if isinstance(f, In) else {f.value}
                self.communities = names if self.communities is None else self.communities & names
            else:
                yield f

    def _wanted(self, year: int | None, month: int | None) -> bool:
        for column, kind, value in self.file_tests:
            v = year if column == "year" else month
            if v is None:
                return False
            ok = {
                EqualTo: lambda: v == value,
                In: lambda: v in value,
                GreaterThan: lambda: v > value,
                GreaterThanOrEqual: lambda: v >= value,
                LessThan: lambda: v < value,
                LessThanOrEqual: lambda: v <= value,
            }[kind]()
            if not ok:
                return False
        return True

    def partitions(self) -> list[DumpTask]:
        from pyarrow import fs as pafs

        filesystem, inner = _open(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")
        infos = filesystem.get_file_info(inner)
        infos = filesystem.get_file_info(pafs.FileSelector(inner, recursive=False)) if infos.type == pafs.FileType.Directory else [infos]
        prefix = self.path.rstrip("/") + "/" if len(infos) != 1 or infos[0].path != inner else None
        out: list[DumpRange] = []
        for info in sorted(infos, key=lambda i: i.path):
            found = FILE_RE.match(info.base_name)
            if info.type != pafs.FileType.File or not info.base_name.startswith("RC_"):
                continue
            year, month = (int(found[1]), int(found[2])) if found else (None, None)
            if self._wanted(year, month):
                path = prefix + info.base_name if prefix else self.path
                out += _ranges(path if ":" in path else f"file://{path}", year, month, info.size, self.split)
        return _tasks(out)

    def read(self, task: DumpTask | None) -> Iterator[pa.RecordBatch]:
        for part in task.ranges if task else []:  # none: no file is wanted
            yield from self._read(part)

    def _read(self, part: DumpRange) -> Iterator[pa.RecordBatch]:
        filesystem, inner = _open(part.path)
        rows: list[tuple] = []
        size = 0
        with filesystem.open_input_file(inner) as fh:
            pieces = _decompressed(fh, part) if part.path.endswith(".zst") else _plain(fh, part)
            for line in lines_of(pieces, part.start == 0):
                raw = line.removesuffix(b"\r").decode("utf-8", "replace")
                row = self._row(raw)
                if self.communities is not None and row[1] not in self.communities:
                    continue
                rows.append((*row[:3], raw, part.year, part.month, row[3]))
                size += len(line)
                if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _row(self, raw: str) -> tuple[str | None, str | None, str | None, bool]:
        """id, subreddit, body, corrupt."""
        try:
            found = json.loads(raw)
        except ValueError:
            found = None
        if not isinstance(found, dict):
            if self.failfast:
                raise ValueError(f"malformed comment: {raw[:200]}")
            return None, None, None, True
        id_, subreddit, body = (_text(found.get(c)) for c in ("id", "subreddit", "body"))
        return id_, subreddit, body, body is None


def _text(value) -> str | None:
    """A field as a string column has it: other JSON values as their text."""
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))


_ARROW = pa.schema(
    [pa.field(c, pa.string()) for c in ("id", "subreddit", "body", "raw")]
    + [pa.field("year", pa.int32()), pa.field("month", pa.int32()), pa.field("corrupt", pa.bool_())]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


class CommentDumps(DataSource):
    """Options: ``path`` (a folder or one file), ``failfast``, ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DumpReader:
        return DumpReader(dict(self.options))


def scan_dumps(
    spark: SparkSession,
    path: str,
    months: list[tuple[int, int]] | None = None,
    communities: list[str] | None = None,
    failfast: bool = False,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Comments (``SCHEMA``) of the dumps under ``path``; ``months`` ((year, month)
    pairs) and ``communities`` (a short list of names) reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CommentDumps)
    reader = spark.read.format(NAME).option("failfast", str(failfast).lower()).option("splitBytes", str(split_bytes))
    df = reader.load(path)
    if months is not None:
        years, numbers = sorted({y for y, _ in months}), sorted({m for _, m in months})
        df = df.where(F.col("year").isin(years) & F.col("month").isin(numbers))
        pairs = [(F.col("year") == y) & (F.col("month") == m) for y, m in months]
        if len(pairs) < len(years) * len(numbers):
            df = df.where(F.lit(False) if not pairs else _any(pairs))
    if communities is not None:
        df = df.where(F.col("subreddit").isin(list(communities)))
    return df


def _any(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out
