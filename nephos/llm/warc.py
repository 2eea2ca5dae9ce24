"""Legacy archives to WARC: ARC files of either version in, WARC 1.1 files out, and a reader of both.

An ARC file opens with a version block, whose URL line, version line and field
list say which header lines follow: version 1 has five fields, version 2 ten.  A
record is a header line, as many bytes as the line declares, and a line feed.  The
converter takes each record's parts from its line, cuts its block by the declared
length, and synthesises what WARC asks for: a record id (a UUID from the file's
name and the record's number, so a task that runs again writes the same), an ISO
date, the record's type, and SHA-1 digests of block and payload.

Files are read and written as streams, a record at a time, each record its own gzip
member; one ARC file becomes one WARC file, under the attempt's name until whole.
A first pass leaves one narrow row a record; equal payloads of LEAST_BYTES or more
meet there by SHA-256 and length, partly summed before the shuffle, and only what
they decide goes back to the files.  Hot payloads are met without a
shuffle (``common.spread``).

Defined cases: a null page is an empty payload; null and empty URLs become
UNKNOWN_URL, white space and controls in URLs are percent-encoded; of equal payloads
the record of the greatest page id is the response, a null id is the least, of equal
ids the last by file and number; repeated rows are records of their own; a very long
page is one record; a block that isn't an HTTP message is a ``resource``, with no
revisits; a record cut short is kept with WARC-Truncated, its digests those of what
is there; dates with fewer digits are filled up, impossible ones become the
archive's; a header line that fits no version raises, with its file and number;
extra columns, whatever their names, are ignored; an empty table gives no files and
no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime
from itertools import groupby

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephos.llm.common import map_arrow, spread
from nephos.session import drop_shared, shared_path, ship_package, write_shared

LEAST_BYTES = 1000
#: Uncompressed bytes after which a file ends, and the compression level of members.
FILE_BYTES, LEVEL = 64 << 20, 1
UNKNOWN_URL, NO_IP = "unknown:", "0.0.0.0"
#: Fixed values of the two formats.
VERSIONS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The header lines of the two versions; URLs and types may hold spaces, the fields between them can't.
_HEAD = r"(?P<url>.+?) (?P<ip>[0-9A-Fa-f.:]+|-) (?P<date>\d{4,17}) (?P<mime>.*?)"
_LINES = {
    1: re.compile(_HEAD + r" (?P<length>\d+)"),
    2: re.compile(_HEAD + r" (?P<status>\d{3}|-) (?P<checksum>\S+) (?P<location>\S+) (?P<offset>\d+|-) (?P<file>\S+) (?P<length>\d+)"),
}
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
PAGE_HEADER = "X-Page-Id"


@dataclass(frozen=True)
class ArcRecord:
    number: int
    url: str
    ip: str
    date: str
    mime: str
    block: bytes
    truncated: bool


@dataclass(frozen=True)
class WarcRecord:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["WARC-Type"]


def gzipped(data: bytes) -> bytes:
    """One gzip member."""
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def base_name(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


@contextmanager
def reading(path: str):
    """The uncompressed bytes of a file as a stream."""
    fs, place = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(place, compression=None) as raw:
        yield io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 20)


@contextmanager
def writing(folder: str, name: str):
    """A stream to ``name``, there whole or not at all: under the attempt's name first, then renamed."""
    fs, base = pafs.FileSystem.from_uri(folder)
    beside = f"{base}/_attempt-{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}-{name}"
    with fs.open_output_stream(beside, compression=None) as out:
        yield out
    try:
        fs.move(beside, f"{base}/{name}")
    except OSError:  # stores that don't rename over a file that an earlier attempt left
        fs.delete_file(f"{base}/{name}")
        fs.move(beside, f"{base}/{name}")


# ARC


def safe_url(url: str | None) -> str:
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else UNKNOWN_URL


def arc_line(version: int, url: str, date: str, mime: str, length: int, file: str = "-", offset: int = 0, status: str = "200") -> bytes:
    middle = "" if version == 1 else f" {status} - - {offset} {file}"
    return f"{url} {NO_IP} {date} {mime}{middle} {length}\n".encode()


def version_block(version: int, file: str, date: str) -> bytes:
    body = f"{version} 0 nephos\n{VERSIONS[version]}\n\n".encode()
    return arc_line(version, f"filedesc://{file}", date, "text/plain", len(body), file) + body + b"\n"


def arc_version(stream: io.BufferedReader, where: str) -> tuple[int, str]:
    """The version and the date of an archive, from its version block."""
    line = stream.readline().decode("utf-8", "replace").rstrip("\r\n")
    m = _LINES[2].fullmatch(line) or _LINES[1].fullmatch(line)
    if not line.startswith("filedesc://") or m is None:
        raise ValueError(f"{where} opens with no version block")
    first, _, fields = stream.read(int(m["length"])).decode("utf-8", "replace").partition("\n")
    named = fields.split("\n", 1)[0].split()
    version = next((v for v, names in VERSIONS.items() if names.lower().split() == [f.lower() for f in named]), None)
    if version is None or first.split(" ", 1)[0] != str(version):
        raise ValueError(f"{where} has an unknown version: {first!r}")
    return version, m["date"]


def arc_records(stream: io.BufferedReader, where: str) -> Iterator[ArcRecord]:
    """The records of an ARC file, in order, cut by their declared lengths."""
    version, archived = arc_version(stream, where)
    number = 0
    while line := stream.readline():
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:  # between records
            continue
        m = _LINES[version].fullmatch(text)
        if m is None:
            raise ValueError(f"{where}, record {number}: no header line of version {version}: {text[:200]!r}")
        length = int(m["length"])
        block = stream.read(length)
        yield ArcRecord(number, m["url"], m["ip"], iso_date(m["date"], archived), m["mime"], block, len(block) < length)
        number += 1


def iso_date(digits: str, archived: str = "") -> str:
    """WARC's date of an archive's digits; those of the archive where they name no time."""
    for d in (digits, archived):
        whole = (d + "00000101000000"[len(d) :])[:14]
        try:
            return datetime.strptime(whole, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ") if len(d) >= 4 else ""
        except ValueError:
            continue
    return "1970-01-01T00:00:00Z"


def http_parts(block: bytes) -> tuple[bytes, bytes] | None:
    """Head (its blank line too) and payload of an HTTP message; None if it isn't one."""
    if not block.startswith(b"HTTP/"):
        return None
    at = min((k + len(e) for e in (b"\r\n\r\n", b"\n\n") if (k := block.find(e)) >= 0), default=len(block))
    return block[:at], block[at:]


def page_of(head: bytes) -> int | None:
    m = re.search(rf"(?im)^{PAGE_HEADER}: *(-?\d+) *\r?$", head.decode("latin-1"))
    return int(m[1]) if m else None


def write_arc(pages: DataFrame, folder: str) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html), versions 1 and 2 by turns of the tasks; a reader of their names."""
    spark = pages.sparkSession
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        version, number, names = 1 + shard % 2, 0, []
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        row = next(rows, None)
        while row is not None:
            name, held = f"pages-{shard:06d}-{number:06d}.arc.gz", 0
            with writing(folder, name) as out:
                out.write(gzipped(version_block(version, name, row[2])))
                while row is not None and held < FILE_BYTES:
                    page_id, url, date, html = row
                    tag = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n{tag}\r\n".encode()
                    line = arc_line(version, safe_url(url), date, "text/html", len(head) + len(html), name, held)
                    out.write(gzipped(b"".join((line, head, html, b"\n"))))
                    held += len(line) + len(head) + len(html) + 1
                    row = next(rows, None)
            names.append(name)
            number += 1
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])

    # Pages carry no time; theirs follows from the id, a second each, from 1996 on.
    at = F.timestamp_seconds(F.lit(820_454_400) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(100_000_000)))
    rows = pages.select("page_id", "url", F.date_format(at, "yyyyMMddHHmmss").alias("date"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("html"))
    rows.mapInArrow(run, "file string").write.format("noop").mode("overwrite").save()
    return archive_files(spark, folder, "*.arc.gz")


def archive_files(spark: SparkSession, folder: str, names: str) -> DataFrame:
    """(file) of the archives in ``folder``; nothing of them is read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", names).load(folder).select(F.col("path").alias("file"))


def _rows(records: Iterator[tuple], schema: pa.Schema, most: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in records:
        held.append(r)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held.clear()
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def arc_index(files: DataFrame) -> DataFrame:
    """(file, number, page_id, url, date, n_bytes, identity) of every HTTP record."""
    out = pa.schema([("file", pa.string()), ("number", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("n_bytes", pa.int64()), ("identity", pa.binary())])

    def records(paths: list[str]) -> Iterator[tuple]:
        for path in paths:
            with reading(path) as stream:
                for r in arc_records(stream, path):
                    if (parts := http_parts(r.block)) is not None:
                        yield path, r.number, page_of(parts[0]), r.url, r.date, len(parts[1]), hashlib.sha256(parts[1]).digest()

    return map_arrow(files, lambda b: _rows(records(b.column(0).to_pylist()), out), "file string, number bigint, page_id bigint, url string, date string, n_bytes bigint, identity binary")


def repeated(index: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(key, first, n): the payloads of at least ``least`` bytes that several records have, and the place of the response."""
    place = F.struct("page_id", "file", "number", "url", "date")
    return index.where(F.col("n_bytes") >= least).groupBy(F.struct("identity", "n_bytes").alias("key")).agg(F.max(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")


def revisits(index: DataFrame, firsts: DataFrame) -> DataFrame:
    """(file, number, first) of the records that repeat the payload of a response of ``firsts``."""
    keyed = index.select("file", "number", F.struct("identity", "n_bytes").alias("key"))
    found = spread(keyed, firsts, "key", index.count())
    return found.where((F.col("file") != F.col("first.file")) | (F.col("number") != F.col("first.number"))).select("file", "number", "first")


# WARC


def record_id(file: str, number: int) -> str:
    """The same for every run: from the archive's own name and the record's place."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{base_name(file)}#{number}')}>"


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", sha1(block)), ("Content-Length", str(len(block)))])
    return b"".join((b"WARC/1.1\r\n", lines.encode(), b"\r\n", block, b"\r\n\r\n"))


def converted(r: ArcRecord, file: str, info_id: str, first: dict | None) -> bytes:
    """The WARC record of an ARC record; ``first`` is the response that it repeats, if any."""
    parts = http_parts(r.block)
    kind = "resource" if parts is None else "response" if first is None else "revisit"
    headers = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_id(file, r.number)), ("WARC-Date", r.date), ("WARC-Target-URI", safe_url(r.url)),
        ("WARC-Warcinfo-ID", info_id), ("WARC-IP-Address", r.ip), ("WARC-Payload-Digest", sha1(r.block if parts is None else parts[1])),
        ("Content-Type", r.mime or "application/octet-stream") if parts is None else ("Content-Type", "application/http; msgtype=response"),
    ]
    if kind == "revisit":
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first["file"], first["number"])), ("WARC-Refers-To-Target-URI", safe_url(first["url"])), ("WARC-Refers-To-Date", first["date"])]
    if r.truncated:
        headers.append(("WARC-Truncated", "unspecified"))
    return warc_record(headers, parts[0] if kind == "revisit" else r.block)


def convert(files: DataFrame, folder: str, index: DataFrame | None = None, least: int = LEAST_BYTES) -> DataFrame:
    """WARC files in ``folder`` of the ARC ``files``, by ``index`` if they are indexed already; a reader of their names.

    A file and the revisits in it, sorted, go to one task, which reads and writes streams.
    """
    spark = files.sparkSession
    index = arc_index(files) if index is None else index
    firsts = write_shared(repeated(index, least), "arc-firsts")
    first = revisits(index, firsts)
    none = F.lit(None).cast(first.schema["first"].dataType)
    asked = files.select("file", F.lit(-1).cast("bigint").alias("number"), none.alias("first")).unionByName(first)
    ship_package(spark)

    def one(path: str, found: Iterator[tuple]) -> str:
        name = re.sub(r"(\.arc)?(\.gz)?$", "", base_name(path)) + ".warc.gz"
        info_id = record_id(path, -1)
        ahead = next(found, None)
        with reading(path) as stream, writing(folder, name) as out:
            fields = f"software: nephos\r\nformat: WARC File Format 1.1\r\nconformsTo: http://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/\r\nisPartOf: {base_name(path)}\r\n".encode()
            started = False
            for r in arc_records(stream, path):
                if not started:
                    out.write(gzipped(warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", info_id), ("WARC-Date", r.date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], fields)))
                    started = True
                same = None
                if ahead is not None and ahead[1] == r.number:
                    same, ahead = ahead[2], next(found, None)
                out.write(gzipped(converted(r, path, info_id, same)))
        return name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for path, found in groupby(rows, lambda r: r[0]):
            next(found)  # the file's own row, before its revisits
            yield pa.RecordBatch.from_arrays([pa.array([one(path, found)])], names=["file"])

    # The rows are few and small, the files are not: a number of tasks keeps Spark from drawing them together.
    tasks = max(files.count(), 1)
    ordered = asked.repartition(tasks, "file").sortWithinPartitions("file", "number")
    ordered.mapInArrow(run, "file string").write.format("noop").mode("overwrite").save()
    drop_shared(firsts)
    return archive_files(spark, folder, "*.warc.gz")


def warc_records(stream: io.BufferedReader, where: str) -> Iterator[WarcRecord]:
    """The records of a WARC file, in order; each block is held to its digest."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{where}: no WARC record: {line[:100]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name] = value.strip()
        block = stream.read(int(headers["Content-Length"]))
        if headers.get("WARC-Block-Digest", sha1(block)) != sha1(block):
            raise ValueError(f"{where}: {headers.get('WARC-Record-ID')} does not match its digest")
        yield WarcRecord(headers, block)


def warc_index(files: DataFrame) -> DataFrame:
    """(page_id, record_id, kind, refers, n_bytes, digest) of every response and revisit; a response's digest is that of what was read."""
    out = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("kind", pa.string()), ("refers", pa.string()), ("n_bytes", pa.int64()), ("digest", pa.string())])

    def records(paths: list[str]) -> Iterator[tuple]:
        for path in paths:
            with reading(path) as stream:
                for r in warc_records(stream, path):
                    if r.kind not in ("response", "revisit"):
                        continue
                    head, payload = http_parts(r.block) or (b"", r.block)
                    digest = base64.b32decode(r.headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if r.kind == "response" and digest != hashlib.sha1(payload).hexdigest():
                        raise ValueError(f"{path}: payload of {r.headers['WARC-Record-ID']} does not match its digest")
                    yield page_of(head), r.headers["WARC-Record-ID"], r.kind, r.headers.get("WARC-Refers-To"), len(payload), digest

    return map_arrow(files, lambda b: _rows(records(b.column(0).to_pylist()), out), "page_id bigint, record_id string, kind string, refers string, n_bytes bigint, digest string")


def resolved(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of an index's records; a revisit's bytes are those of its response."""
    plain = index.where("kind = 'response'")
    again = index.where("kind = 'revisit'")
    asked = again.groupBy("refers").agg(F.count(F.lit(1)).alias("n"))
    firsts = plain.select(F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"), F.col("n_bytes").alias("payload_bytes"))
    known = firsts.join(asked, "refers")
    met = spread(again.select("page_id", "refers", "digest", "kind"), known, "refers", index.count())
    out = ["page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to"]
    return plain.withColumns({"payload_bytes": F.col("n_bytes"), "refers_to": F.lit(None).cast("bigint")}).select(*out).unionByName(met.select(*out))


def page_archives(pages: DataFrame) -> DataFrame:
    """What ``resolved`` reads back from WARC files that were converted from ARC files of ``pages``; the files go once they are read."""
    spark = pages.sparkSession
    old, new = (shared_path(spark, f"{kind}-{uuid.uuid4().hex}") for kind in ("arc", "warc"))
    files = write_arc(pages, old)
    index = write_shared(arc_index(files), "arc-index")
    made = convert(files, new, index)
    drop_folder(spark, old)
    drop_shared(index)
    read = write_shared(warc_index(made), "warc-index")
    drop_folder(spark, new)
    return resolved(read)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
