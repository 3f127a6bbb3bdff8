"""Legacy archive converter: ARC files to WARC files.

An ARC file starts with a ``filedesc://`` record that names its version; each
record is one header line, whose fields depend on the version, and as many bytes
as its last field declares. The converter reads records by these declared
lengths and writes WARC/1.0 records with what WARC wants and ARC lacks: a record
id (a name-based UUID of file and offset), an ISO timestamp, a type, block and
payload digests. Of records with equal payloads of at least ``min_bytes`` the one
with the smallest page id is the ``response``, the others become ``revisit``
records that refer to it and carry the HTTP header only.

Archives are files of gzip members, one per record, of about ``FILE_BYTES`` of
content. Tasks write them below the shared folder under names of their own; a
manifest table, which Spark commits, lists those of the attempts that counted,
and only listed files are read. Steps: ARC files -> digests per record -> the
smallest page id per digest -> each ARC file with the decisions on its own
records -> WARC file. Payloads never go through a shuffle.

A null payload is empty, a null or empty URL ``unknown:``, a null page id is kept
as null (such a record is a response unless another has its payload). Equal page
ids with equal payloads: the first by file and offset is the response. White space
in URLs is percent-encoded. Empty tables give empty archives and no rows. Other
columns are not read."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordform.llm.common import scratch_path, table, written

#: Content bytes of an archive file, after which a task begins the next one.
FILE_BYTES = 32 << 20
#: Copies of a class's response that its revisits are spread over.
SALTS = 32

# The field lists of the two versions of ARC, and the blank of an unknown field.
_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_NONE = "-"
_ADDRESS = "0.0.0.0"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path of Spark's (``file:/x``, ``hdfs://...``, ``s3a://...``, or plain) and the path in it."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path):
        path = re.sub(r"^file:/+", "file:///", path)
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
    return pafs.LocalFileSystem(), path


class _Files:
    """Archive files of one task: gzip members appended until a file is full."""

    def __init__(self, folder: str, suffix: str, begin: Callable[[str], bytes] | None = None):
        self.fs, self.folder = _open(folder)
        self.prefix, self.suffix, self.begin = folder, suffix, begin
        self.out, self.done, self.n = None, [], 0

    def write(self, record: bytes) -> tuple[str, int]:
        """Append a record; its file's name and its place among the file's records."""
        if self.out is not None and self.size >= FILE_BYTES:
            self.close()
        if self.out is None:
            context = TaskContext.get()
            self.name = f"{context.stageId()}-{context.partitionId()}-{context.taskAttemptId()}-{self.n}{self.suffix}"
            self.n += 1
            self.fs.create_dir(self.folder, recursive=True)
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            self.size, self.records = 0, 0
            if self.begin:
                self._member(self.begin(self.name))
        self._member(record)
        self.records += 1
        return self.name, self.records - 1

    def _member(self, record: bytes) -> None:
        self.out.write(gzip.compress(record, 4, mtime=0))
        self.size += len(record)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.prefix}/{self.name}", self.records, self.size))
            self.out = None

    def manifest(self) -> Iterator[pa.RecordBatch]:
        self.close()
        if self.done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*self.done)], names=["path", "records", "bytes"])


_MANIFEST = "path string, records bigint, bytes bigint"


class _Reader:
    """Lines and declared lengths of the uncompressed content of an archive file."""

    def __init__(self, path: str):
        fs, path = _open(path)
        self.raw = fs.open_input_stream(path, compression=None)
        self.stream = gzip.GzipFile(fileobj=self.raw)

    def line(self) -> bytes:
        return self.stream.readline()

    def take(self, n: int) -> bytes:
        got = self.stream.read(n)
        if len(got) < n:
            raise ValueError(f"archive ends {n - len(got)} bytes before a declared length")
        return got


# -- ARC ------------------------------------------------------------------------


def _url(url: str | None) -> str:
    return re.sub(r"[\s\x00-\x20]", lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), url or "") or "unknown:"


def arc_begin(name: str, version: int, date: str) -> bytes:
    """The version block of an ARC file."""
    body = f"{version} 0 origin\n{_FIELDS[version]}\n"
    known = {"URL": f"filedesc://{name}", "IP-address": _ADDRESS, "Archive-date": date, "Content-type": "text/plain", "Result-code": "200", "Offset": "0", "Filename": name, "Archive-length": str(len(body))}
    return (" ".join(known.get(f, _NONE) for f in _FIELDS[version].split()) + "\n" + body + "\n").encode()


def arc_record(version: int, name: str, url: str | None, date: str, block: bytes) -> bytes:
    known = {"URL": _url(url), "IP-address": _ADDRESS, "Archive-date": date, "Content-type": "text/html", "Result-code": "200", "Offset": "0", "Filename": name, "Archive-length": str(len(block))}
    return " ".join(known.get(f, _NONE) for f in _FIELDS[version].split()).encode() + b"\n" + block + b"\n"


def arc_records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by name, block) of each record of an ARC file after its version block."""
    reader = _Reader(path)
    head = reader.line().split()
    if not head or not head[0].startswith(b"filedesc://"):
        raise ValueError(f"{path}: no version block")
    block = reader.take(int(head[-1])).decode()
    version = int(block.split(None, 1)[0])
    if version not in _FIELDS:
        raise ValueError(f"{path}: ARC version {version}")
    names = block.split("\n")[1].split()
    while True:
        line = reader.line()
        if not line:
            return
        if line == b"\n":  # between records
            continue
        values = line.rstrip(b"\n").decode("utf-8", "replace").split(" ")
        if len(values) != len(names):
            raise ValueError(f"{path}: {len(values)} fields, not {len(names)}: {line[:200]!r}")
        fields = dict(zip(names, values))
        yield fields, reader.take(int(fields["Archive-length"]))


def write_arc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "20240101000000") -> DataFrame:
    """Write pages as ARC files, odd partitions in version 2; the manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = 1 + TaskContext.get().partitionId() % 2
        files = _Files(folder, ".arc.gz", lambda name: arc_begin(name, version, date))
        for batch in batches:
            for i in range(batch.num_rows):
                key, link, body = (batch.column(c)[i].as_py() for c in range(3))
                payload = (body or "").encode()
                lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
                lines += [f"X-Page-Id: {key}"] if key is not None else []
                files.write(arc_record(version, "part", link, date, "\r\n".join([*lines, "", ""]).encode() + payload))
        yield from files.manifest()

    rows = pages.select(F.col(page_id).cast("bigint"), F.col(url).cast("string"), F.col(html).cast("string"))
    return written(rows.mapInArrow(run, _MANIFEST), "arc-manifest")


# -- HTTP blocks ------------------------------------------------------------------


def http_parts(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(header fields in lower case, header with its empty line, payload) of an
    HTTP response; a block without a header is all payload."""
    at = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or at < 0:
        return {}, b"", block
    fields = {}
    for line in block[:at].split(b"\r\n")[1:]:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, block[: at + 4], block[at + 4 :]


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _each_file(manifest: DataFrame, fn: Callable[[str], Iterator[tuple]], schema: str, kinds: list[pa.DataType], names: list[str]) -> DataFrame:
    """Rows that ``fn`` makes of each listed file, in batches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                for row in fn(path):
                    rows.append(row)
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return manifest.select("path").mapInArrow(run, schema)


def spread(manifest: DataFrame) -> DataFrame:
    """Listed files, each in a partition of its own as far as the session's parallelism goes."""
    n = max(1, min(manifest.count(), manifest.sparkSession.sparkContext.defaultParallelism * 4))
    return manifest.repartition(n)


def arc_digests(manifest: DataFrame) -> DataFrame:
    """(path, at, page_id, payload_bytes, digest): one row per ARC record."""

    def rows(path: str) -> Iterator[tuple]:
        for at, (_, block) in enumerate(arc_records(path)):
            fields, _, payload = http_parts(block)
            key = fields.get("x-page-id")
            yield path, at, int(key) if key else None, len(payload), hashlib.sha1(payload).digest()

    return _each_file(
        spread(manifest),
        rows,
        "path string, at bigint, page_id bigint, payload_bytes bigint, digest binary",
        [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()],
        ["path", "at", "page_id", "payload_bytes", "digest"],
    )


def revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(path, at, refers_to, of_path, of_at) of each record that repeats another's
    payload. Only payloads that occur twice are joined, a class's records spread
    over ``SALTS`` keys."""
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "path", "at")
    twice = (
        records.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("digest", "payload_bytes")
        .agg(F.count("*").alias("m"), F.min(order).alias("first"))
        .where("m > 1")
        .select("digest", "payload_bytes", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = records.withColumn("salt", F.pmod(F.xxhash64("path", "at"), F.lit(SALTS)).cast("int"))
    return (
        salted.join(twice, ["digest", "payload_bytes", "salt"])
        .where((F.col("path") != F.col("first.path")) | (F.col("at") != F.col("first.at")))
        .select("path", "at", F.col("first.page_id").alias("refers_to"), F.col("first.path").alias("of_path"), F.col("first.at").alias("of_at"))
    )


# -- WARC -------------------------------------------------------------------------


def record_id(path: str, at: int) -> str:
    """A UUID named by the ARC file and the record's place in it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path.rsplit('/', 1)[-1]}#{at}')}>"


def iso_time(date: str) -> str:
    """The 14 digits of an ARC date (fewer: the earliest such time) as WARC writes it."""
    full = (date + "00000101000000"[len(date) :])[:14] if date.isdigit() else "19700101000000"
    try:
        return datetime.strptime(full, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "\r\n".join(["WARC/1.0", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""])
    return head.encode() + block + b"\r\n\r\n"


def warc_records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a WARC file."""
    reader = _Reader(path)
    while True:
        line = reader.line()
        if not line:
            return
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{path}: not a record: {line[:200]!r}")
        fields = {}
        while (line := reader.line()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip()] = value.strip()
        yield fields, reader.take(int(fields["Content-Length"]))


def convert(manifest: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Convert listed ARC files to WARC files in ``folder``; their manifest."""
    records = written(arc_digests(manifest), "arc-records")
    # the decisions on a file's records go with the file: they are as bounded as it is
    decided = (
        revisits(records, min_bytes)
        .groupBy("path")
        .agg(F.collect_list(F.struct("at", "refers_to", "of_path", "of_at")).alias("revisits"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info", 0)), ("WARC-Date", iso_time("")), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.0\r\n")
        files = _Files(folder, ".warc.gz", lambda name: info)
        for batch in batches:
            for path, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                repeats = {r["at"]: r for r in found or ()}
                for at, (fields, block) in enumerate(arc_records(path)):
                    http, header, payload = http_parts(block)
                    repeat = repeats.get(at)
                    body = header if repeat else block
                    out = [
                        ("WARC-Type", "revisit" if repeat else "response"),
                        ("WARC-Record-ID", record_id(path, at)),
                        ("WARC-Date", iso_time(fields["Archive-date"])),
                        ("WARC-Target-URI", fields["URL"]),
                        ("WARC-IP-Address", fields["IP-address"]),
                        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
                        ("WARC-Block-Digest", f"sha1:{sha1_base32(body)}"),
                        ("Content-Type", "application/http; msgtype=response" if http else fields["Content-type"]),
                        ("X-Payload-Length", str(len(payload))),
                    ]
                    if http.get("x-page-id"):
                        out.append(("X-Page-Id", http["x-page-id"]))
                    if repeat:
                        out.append(("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))
                        out.append(("WARC-Refers-To", record_id(repeat["of_path"], repeat["of_at"])))
                        if repeat["refers_to"] is not None:
                            out.append(("X-Refers-To-Page-Id", str(repeat["refers_to"])))
                    files.write(warc_record(out, body))
        yield from files.manifest()

    todo = manifest.select("path").join(decided, "path", "left").select("path", "revisits")
    return written(spread(written(todo, "decided")).mapInArrow(run, _MANIFEST), "warc-manifest")


def read_warc(manifest: DataFrame) -> DataFrame:
    """Response and revisit records of listed WARC files, digests checked."""

    def rows(path: str) -> Iterator[tuple]:
        for fields, block in warc_records(path):
            kind = fields.get("WARC-Type")
            if kind not in ("response", "revisit"):
                continue
            declared = fields["WARC-Payload-Digest"].partition(":")[2]
            _, _, payload = http_parts(block)
            if kind == "response" and sha1_base32(payload) != declared:
                raise ValueError(f"{path}: {fields['WARC-Record-ID']} doesn't have its digest")
            number = lambda name: int(fields[name]) if fields.get(name) else None
            yield (
                number("X-Page-Id"), fields.get("WARC-Target-URI"), fields.get("WARC-Date"), fields["WARC-Record-ID"], kind, number("X-Payload-Length"),
                declared, fields.get("WARC-Refers-To"), number("X-Refers-To-Page-Id"), payload if kind == "response" else None,
            )

    kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "date", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to_id", "refers_to", "payload"]
    schema = "page_id bigint, url string, date string, record_id string, record_type string, payload_bytes bigint, payload_digest string, refers_to_id string, refers_to bigint, payload binary"
    return _each_file(spread(manifest), rows, schema, kinds, names)


def op2_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC files, converted to WARC files, read back."""
    pages = table(spark, sf_dir, "pages")
    arcs = write_arc(pages, scratch_path(spark, "arc"))
    warcs = convert(arcs, scratch_path(spark, "warc"))
    return read_warc(warcs).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
with records as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages
), ranked as (
  select page_id, payload_bytes, h,
         row_number() over (partition by h order by page_id nulls last) as r,
         first_value(page_id) over (partition by h order by page_id nulls last) as least
  from records
)
select page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, (i // 4)::int * 5 + 1, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int + 1, 1)
         for i in range(32)], '') as payload_digest,
       case when r = 1 then 'response' else 'revisit' end as record_type,
       case when r > 1 then least end as refers_to
from ranked
"""
