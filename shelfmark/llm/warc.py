"""Web archives packed in ZIP files: written with repeats as revisits, read by ranges.

An archive is a ZIP file with two stored members: `archive/data.warc.gz`, whose records are gzip members
of their own, and `indexes/index.cdx`, a line per record with its place. The reader never extracts a
member. It reads the end of the file, finds the central directory (by its ZIP64 record where there is
one), takes a member's place from there and its local header, reads the index, and then fetches
stretches of records by their byte range. Stretches of all archives are dealt to the tasks.

Files go to a folder that every executor reaches, under names of their own for every attempt of a task; the
list of a run's files is written once its tasks are done, so what a lost attempt left is never read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.blocks import ready, staged
from shelfmark.session import fresh_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
LEAST_PAYLOAD = 100
# Bytes of records after which an archive is closed, and bytes of records read at once.
ARCHIVE_BYTES = 256 << 20
STRETCH = 4 << 20
#: Fixed values of the ZIP format: signatures, and the marks that refer to ZIP64 fields.
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class BadArchive(ValueError):
    """The bytes are not a ZIP archive of records."""


# Reading -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


def read_at(file: BinaryIO, at: int, n: int) -> bytes:
    file.seek(at)
    data = file.read(n)
    if len(data) != n:
        raise BadArchive(f"{n} bytes wanted at {at}, {len(data)} there")
    return data


def directory(file: BinaryIO, size: int) -> dict[str, Member]:
    """Members by name, from the central directory."""
    tail_at = max(0, size - 22 - FULL16)
    tail = read_at(file, tail_at, size - tail_at)
    place = tail.rfind(END)
    while place >= 0 and tail[place + 20 : place + 22] != struct.pack("<H", max(0, len(tail) - place - 22)):
        place = tail.rfind(END, 0, place)  # these bytes stand in the comment
    if place < 0 or len(tail) - place < 22:
        raise BadArchive("no end of central directory")
    count, length, start = struct.unpack("<HII", tail[place + 10 : place + 20])
    end = tail_at + place
    if FULL16 == count or FULL32 in (length, start):
        locator = read_at(file, end - 20, 20)
        if locator[:4] != LOCATOR:
            raise BadArchive("no ZIP64 locator")
        record = read_at(file, struct.unpack("<Q", locator[8:16])[0], 56)
        if record[:4] != END64:
            raise BadArchive("no ZIP64 end of central directory")
        count, length, start = struct.unpack("<QQQ", record[32:56])
    data, at, members = read_at(file, start, length), 0, {}
    for _ in range(count):
        if data[at : at + 4] != ENTRY:
            raise BadArchive("no entry where the central directory should have one")
        method = struct.unpack("<H", data[at + 10 : at + 12])[0]
        packed, unpacked, names, extras, comments = struct.unpack("<IIHHH", data[at + 20 : at + 34])
        header = struct.unpack("<I", data[at + 42 : at + 46])[0]
        name = data[at + 46 : at + 46 + names].decode()
        wide = _wide_fields(data[at + 46 + names : at + 46 + names + extras])
        if unpacked == FULL32:
            wide = wide[8:]
        if packed == FULL32:
            packed, wide = struct.unpack("<Q", wide[:8])[0], wide[8:]
        if header == FULL32:
            header = struct.unpack("<Q", wide[:8])[0]
        members[name] = Member(name, method, packed, header)
        at += 46 + names + extras + comments
    return members


def _wide_fields(extra: bytes) -> bytes:
    """The ZIP64 extra field: eight bytes for each field that is full, in their order."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack("<HH", extra[at : at + 4])
        if kind == 1:
            return extra[at + 4 : at + 4 + n]
        at += 4 + n
    return b""


def data_start(file: BinaryIO, member: Member) -> int:
    """Where a stored member's bytes begin: the local header has name and extra lengths of its own."""
    if member.method != 0:
        raise BadArchive(f"{member.name} is not stored")
    header = read_at(file, member.header, 30)
    if header[:4] != LOCAL:
        raise BadArchive("no local header")
    names, extras = struct.unpack("<HH", header[26:30])
    return member.header + 30 + names + extras


def opened(path: str) -> tuple[pa.NativeFile, int]:
    system, inside = fs.FileSystem.from_uri(path)
    return system.open_input_file(inside), system.get_file_info(inside).size


def index_lines(file: BinaryIO, members: dict[str, Member]) -> Iterator[bytes]:
    """Lines of the index member, read stretch by stretch."""
    member = members[INDEX]
    at, left, rest = data_start(file, member), member.size, b""
    while left:
        n = min(left, STRETCH)
        lines = (rest + read_at(file, at, n)).split(b"\n")
        rest = lines.pop()
        yield from lines
        at, left = at + n, left - n
    if rest:
        yield rest


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and block of one unpacked record."""
    head, separator, rest = data.partition(b"\r\n\r\n")
    if not separator or not head.startswith(b"WARC/"):
        raise BadArchive("not a WARC record")
    _, *lines = head.decode().split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    n = int(headers["content-length"])
    if len(rest) < n:
        raise BadArchive("record is cut off")
    return headers, rest[:n]


# Writing -----------------------------------------------------------------------------------------


def record(headers: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member; line breaks inside header values are escaped."""
    lines = ["WARC/1.1"]
    for name, value in (headers | {"Content-Length": str(len(block))}).items():
        lines.append(f"{name}: {value.replace('%', '%25') if chr(10) in value or chr(13) in value else value}".replace("\r", "%0D").replace("\n", "%0A"))
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def urn(id: int | None) -> str:
    return f"<urn:page:{'' if id is None else id}>"


def id_of(name: str | None) -> int | None:
    inside = (name or "")[len("<urn:page:") : -1]
    return int(inside) if inside else None


def page_record(page: dict) -> bytes:
    """Record of a page: a response with its payload, or a revisit that refers to one."""
    payload = page["html"]
    headers = {"WARC-Type": "revisit" if page["refers_to"] is not None else "response", "WARC-Record-ID": urn(page["id"])}
    if page["url"] is not None:
        headers["WARC-Target-URI"] = page["url"]
    headers["WARC-Payload-Digest"] = "sha256:" + hashlib.sha256(payload).hexdigest()
    headers["WARC-Date"] = "1970-01-01T00:00:00Z"
    if page["refers_to"] is None:
        return record(headers | {"Content-Type": "text/html; charset=utf-8"}, payload)
    headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": urn(page["refers_to"]), "X-Payload-Length": str(len(payload))}
    return record(headers, b"")


class ArchiveWriter:
    """One ZIP file in the making; index lines wait in memory, a few bytes for each record."""

    def __init__(self, folder: str, zip64: bool = False) -> None:
        system, inside = fs.FileSystem.from_uri(folder)
        system.create_dir(inside, recursive=True)
        name = f"pages-{uuid.uuid4().hex}.zip"
        self.path = f"{folder}/{name}"
        self.sink = system.open_output_stream(f"{inside}/{name}")
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.zip64 = zip64
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.lines: list[bytes] = []
        self.at = 0

    def add(self, data: bytes) -> None:
        self.data.write(data)
        self.lines.append(json.dumps({"offset": self.at, "length": len(data)}).encode())
        self.at += len(data)

    def close(self) -> tuple[str, int]:
        self.data.close()
        with self.zip.open(INDEX, "w", force_zip64=self.zip64) as index:
            for k in range(0, len(self.lines), 10_000):
                index.write(b"\n".join(self.lines[k : k + 10_000]) + b"\n")
        self.zip.close()
        self.sink.close()
        return self.path, len(self.lines)


def with_revisits(pages: DataFrame, id: str, html: str, least: int = LEAST_PAYLOAD) -> DataFrame:
    """`refers_to` for every page: of equal payloads of `least` bytes or more the smallest id, null for
    that page itself and for pages whose payload nobody shares."""
    payload = F.coalesce(pages[html], F.lit("")).cast("binary")
    keyed = pages.withColumn("_digest", F.when(F.octet_length(payload) >= least, F.sha2(payload, 256)))
    shared = (
        keyed.where("_digest IS NOT NULL")
        .groupBy("_digest")
        .agg(F.min(id).alias("_first"), F.count("*").alias("_count"))
        .where("_count > 1 AND _first IS NOT NULL")
        .drop("_count")
    )
    # Short payloads get a digest of their own each, so that no null key gathers them in one task.
    keyed = keyed.withColumn("_digest", F.coalesce("_digest", F.concat(F.lit("short "), F.coalesce(F.col(id).cast("string"), F.lit("")))))
    joined = keyed.join(shared, "_digest", "left")
    refers = F.when(~F.col(id).eqNullSafe(F.col("_first")), F.col("_first"))
    return joined.withColumn("refers_to", refers).drop("_digest", "_first")


def write_archives(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html", archive_bytes: int = ARCHIVE_BYTES, zip64: bool = False
) -> DataFrame:
    """Write a record per page and give the archives: path, n_records.

    Null html is an empty payload, a null url no target. A null id counts as larger than any other. Rows that
    share the smallest id of their payload are all responses. Other columns of pages are left out.
    """
    ready(pages.sparkSession)
    picked = pages.select(F.col(id).cast("long").alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = with_revisits(picked, "id", "html").select("id", "url", "refers_to", F.coalesce("html", F.lit("")).cast("binary").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for page in _rows(batch):
                writer = writer or ArchiveWriter(folder, zip64)
                writer.add(page_record(page))
                if writer.at >= archive_bytes:
                    yield listed(writer)
                    writer = None
        if writer:
            yield listed(writer)

    def listed(writer: ArchiveWriter) -> pa.RecordBatch:
        path, n = writer.close()
        return pa.RecordBatch.from_pydict({"path": [path], "n_records": pa.array([n], pa.int64())})

    return staged(rows.mapInArrow(run, "path string, n_records long"), "archives")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    columns = [batch.column(k) for k in range(batch.num_columns)]
    for k in range(batch.num_rows):
        yield {name: column[k].as_py() for name, column in zip(batch.schema.names, columns, strict=True)}


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives at `path`: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (null for revisits, and where `payloads` is false).

    Length and digest of a response are those of the bytes read, of a revisit what it says of the payload it
    stands for. A digest that does not match, or a file that is no such archive, is an error.
    """
    ready(archives.sparkSession)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                file, size = opened(path)
                with file:
                    members = directory(file, size)
                    begin, held, total = data_start(file, members[DATA]), [], 0
                    for line in index_lines(file, members):
                        place = json.loads(line)
                        if held and total + place["length"] > STRETCH:
                            yield stretch(path, begin, held)
                            begin, held, total = begin + total, [], 0
                        held.append(place["length"])
                        total += place["length"]
                    if held:
                        yield stretch(path, begin, held)

    def stretch(path: str, begin: int, lengths: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": [path], "begin": pa.array([begin], pa.int64()), "lengths": pa.array([lengths], pa.list_(pa.int64()))})

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in _rows(batch):
                file, _ = opened(place["path"])
                with file:
                    data, at, out = read_at(file, place["begin"], sum(place["lengths"])), 0, []
                for n in place["lengths"]:
                    out.append(_page(*parse_record(zlib.decompress(data[at : at + n], 31)), payloads))
                    at += n
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
                names = [part.split()[0] for part in RECORDS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    places = archives.select("path").mapInArrow(stretches, "path string, begin long, lengths array<long>")
    width = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return places.repartition(width, "path", "begin").mapInArrow(fetch, RECORDS)


def _page(headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    id, url, digest = id_of(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-payload-digest"].removeprefix("sha256:")
    if headers["warc-type"] == "revisit":
        return id, url, int(headers["x-payload-length"]), digest, "revisit", id_of(headers["warc-refers-to"]), None
    found = hashlib.sha256(block).hexdigest()
    if found != digest:
        raise BadArchive(f"payload of page {id} does not match its digest")
    return id, url, len(block), found, headers["warc-type"], None, block if payloads else None


def round_trip(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", payloads: bool = False) -> DataFrame:
    """Pages written to archives in the shared folder and read back."""
    return read_archives(write_archives(pages, fresh_dir(pages.sparkSession, "warc"), id, url, html), payloads)
