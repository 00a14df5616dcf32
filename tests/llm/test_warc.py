import hashlib
import io
import zipfile

import pytest

from shelfmark.llm import warc as W
from shelfmark.session import fresh_dir

PAGES = "page_id long, url string, html string, payload string, refers_to long"


def pages():
    long, other = "<p>" + "word " * 40 + "</p>", "<p>" + "ö" * 50
    return [
        (3, "http://a.example/", long, "x", 9),
        (1, "http://b.example/\r\nX-Evil: 1", long, None, None),
        (2, None, long, "x", 9),
        (1, "http://again.example/", long, "x", 9),  # repeats the smallest id
        (4, "u", "short", "x", 9),
        (5, "u", "short", "x", 9),
        (6, "u", None, "x", 9),
        (7, "u", "", "x", 9),
        (None, "u", long, "x", 9),
        (None, "u", other, "x", 9),
        (None, "u", other, "x", 9),
        (8, "u", "\r\n\r\nWARC/1.1\r\n" * 20, "x", 9),
        (9, "u", "z" * 3_000_000, "x", 9),
    ]


def expected(rows):
    out = []
    for id, _, html, *_ in rows:
        data = (html or "").encode()
        same = [i for i, _, h, *_ in rows if h == html and i is not None]
        refers = min(same) if len(data) >= 100 and same and min(same) != id else None
        kind = "revisit" if refers is not None else "response"
        out.append((id, len(data), hashlib.sha256(data).hexdigest(), kind, refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [W.ARCHIVE_BYTES, 300])
def test_round_trip(spark, monkeypatch, size):
    monkeypatch.setattr(W, "STRETCH", 500)
    docs = spark.createDataFrame(pages(), PAGES).repartition(2, "html")
    archives = W.write_archives(docs, fresh_dir(spark, "warc"), archive_bytes=size, zip64=size == 300)
    rows = W.read_archives(archives).collect()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in rows), key=repr) == expected(pages())
    for r in rows:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    urls = {r.url for r in rows if r.page_id == 1}
    assert urls == {"http://b.example/%0D%0AX-Evil: 1", "http://again.example/"}


def test_archives_are_zip_files_of_stored_members(spark):
    docs = spark.createDataFrame(pages(), PAGES).coalesce(1)
    for row in W.write_archives(docs, fresh_dir(spark, "warc")).collect():
        path = row.path.removeprefix("file://")
        with zipfile.ZipFile(path) as archive:
            assert archive.testzip() is None
            assert {i.filename: i.compress_type for i in archive.infolist()} == {W.DATA: 0, W.INDEX: 0}


def test_empty_table(spark):
    assert W.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def zip_bytes(zip64, comment=b"", name="a"):
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as archive:
        with archive.open(name, "w", force_zip64=zip64) as member:
            member.write(b"hello")
        archive.comment = comment
    return sink.getvalue()


@pytest.mark.parametrize("zip64", [False, True])
def test_members_are_found(zip64):
    data = b"prefix of no archive"[:0] + zip_bytes(zip64, b"PK\5\6 in a comment"[:9])
    file = io.BytesIO(data)
    member = W.directory(file, len(data))["a"]
    start = W.data_start(file, member)
    assert data[start : start + member.size] == b"hello"


def test_zip64_directories_are_read():
    """An archive whose end record and entries say 'see ZIP64' for all they can."""
    import struct

    local = W.LOCAL + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, W.FULL32, W.FULL32, 1, 20)
    local += b"a" + struct.pack("<HHQQ", 1, 16, 5, 5) + b"hello"
    entry = W.ENTRY + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, W.FULL32, W.FULL32, 1, 36, 0, 0, 0, 0, W.FULL32)
    entry += b"a" + struct.pack("<HHI", 0x5455, 4, 0) + struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    end64 = W.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), len(local))
    locator = W.LOCATOR + struct.pack("<IQI", 0, len(local) + len(entry), 1)
    end = W.END + struct.pack("<HHHHIIH", 0, 0, W.FULL16, W.FULL16, W.FULL32, W.FULL32, 0)
    data = local + entry + end64 + locator + end
    file = io.BytesIO(data)
    member = W.directory(file, len(data))["a"]
    assert member == W.Member("a", 0, 5, 0)
    start = W.data_start(file, member)
    assert data[start : start + 5] == b"hello"


@pytest.mark.parametrize("data", [b"", b"no archive", zip_bytes(False)[:-30]])
def test_other_files_are_refused(data):
    with pytest.raises(W.BadArchive):
        W.directory(io.BytesIO(data), len(data))
    with pytest.raises(W.BadArchive):
        W.parse_record(data)


def test_packed_members_are_refused():
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a", "x" * 1000)
    data = sink.getvalue()
    with pytest.raises(W.BadArchive):
        W.data_start(io.BytesIO(data), W.directory(io.BytesIO(data), len(data))["a"])
