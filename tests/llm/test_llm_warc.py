"""ZIP packages and WARC records by exact round trips, also through the standard library."""

import hashlib
import io
import zipfile
import zlib

import pytest

from reknit.llm import warc, zips


def package(limit, sizes):
    out = io.BytesIO()
    writer = zips.ZipWriter(out, limit)
    data = {f"part/{k}.bin": bytes([k % 251]) * size for k, size in enumerate(sizes)}
    for name, value in data.items():
        writer.add(name, *zips.checksum([value]), [value])
    writer.close()
    return out.getvalue(), data


@pytest.mark.parametrize("limit, sizes", [
    (zips.FULL32, [0, 1, 5000]), (100, [0, 99, 100, 5000]), (zips.FULL32, []), (1, [3, 4]),
    (zips.FULL32, [1] * 66_000)])
def test_directories(limit, sizes):
    raw, data = package(limit, sizes)
    read = lambda offset, length: raw[offset:offset + length]
    found = zips.members(read, len(raw))
    assert [member.name for member in found] == list(data)
    for member in found[:50]:
        begin = zips.data_offset(read, member)
        assert raw[begin:begin + member.size] == data[member.name]
    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        assert archive.namelist() == list(data)
        assert archive.testzip() is None


def test_packages_of_others_are_read():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        with archive.open("a.txt", "w", force_zip64=True) as member:
            member.write(b"hello")
        archive.writestr(zipfile.ZipInfo("b.txt"), b"x" * 9, zipfile.ZIP_DEFLATED)
        archive.comment = b"a comment with PK\x05\x06 not in it"[:17]
    raw = out.getvalue()
    read = lambda offset, length: raw[offset:offset + length]
    first, second = zips.members(read, len(raw))
    begin = zips.data_offset(read, first)
    assert raw[begin:begin + first.size] == b"hello"
    with pytest.raises(ValueError):
        zips.data_offset(read, second)
    with pytest.raises(ValueError):
        zips.members(lambda offset, length: bytes(length), 100)


def test_records():
    data = warc.record(7, "http://x/a b\r\nEvil: 1", "<p>é\r\n\r\n</p>".encode(), "d1", None)
    parts = warc.parse(data)
    assert parts["payload"].decode() == "<p>é\r\n\r\n</p>" and parts["page"] == 7
    assert parts["url"] == "http://x/a%20b%0D%0AEvil:%201"
    again = warc.parse(warc.record(None, None, b"x" * 2000, "d2", 9))
    assert (again["type"], again["refers_to"], again["length"], again["payload"], again["page"],
            again["url"]) == ("revisit", 9, 2000, None, None, None)


def rows():
    large, other = "é" * 600, "x" * 1000
    return [(1, "http://a/1", large), (2, None, large), (3, "http://a/3", "x" * 999),
            (4, "", "x" * 999), (5, "http://a/5", None), (6, "http://a/6", ""), (9, "u", other),
            (9, "u", other), (8, "u", other), (None, "u", other), (None, "u", "y" * 1200),
            (-3, "u", large), (10, "http://long/", "<p>" * 400_000)]


def plain(table):
    out = []
    for page, _, html in table:
        data = (html or "").encode()
        same = [p for p, _, h in table if (h or "").encode() == data and p is not None]
        refers = max(same, default=None) if len(data) >= 1000 else None
        if refers == page:
            refers = None
        out.append((page, len(data), hashlib.sha1(data).hexdigest(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("package_bytes, range_bytes", [(32_000_000, 4_000_000), (500, 300)])
def test_round_trip(spark, monkeypatch, package_bytes, range_bytes):
    monkeypatch.setattr(warc, "PACKAGE_BYTES", package_bytes)
    monkeypatch.setattr(warc, "RANGE_BYTES", range_bytes)
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string").selectExpr(
        "*", "1 AS digest", "2 AS payload", "3 AS page")
    packages = warc.write_archives(pages)
    found = warc.read_archives(packages)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == plain(rows())
    for row in found.filter("record_type = 'response'").collect():
        assert hashlib.sha1(row.payload).hexdigest() == row.payload_digest
    assert packages.agg({"records": "sum"}).first()[0] == len(rows())
    if package_bytes == 500:
        assert packages.count() > 1
    one = packages.first()
    with zipfile.ZipFile(one.path.removeprefix("file:")) as archive:
        assert archive.namelist() == [warc.ARCHIVE, warc.INDEX]
        first = zlib.decompressobj(31).decompress(archive.read(warc.ARCHIVE))
        assert first.startswith(b"WARC/1.1\r\n")


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    packages = warc.write_archives(pages)
    assert packages.count() == 0
    assert warc.read_archives(packages).count() == 0


def test_damaged_payloads_are_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 50)], "page_id long, url string, html string")
    packages = warc.write_archives(pages, folder=str(tmp_path / "archives"))
    record = warc._zipped(warc.record(1, "u", b"y" * 50, "00", None))
    path = tmp_path / "bad.wacz"
    with path.open("wb") as out:
        writer = zips.ZipWriter(out)
        writer.add(warc.ARCHIVE, *zips.checksum([record]), [record])
        index = b'{"offset": 0, "length": %d}\n' % len(record)
        writer.add(warc.INDEX, *zips.checksum([index]), [index])
        writer.close()
    bad = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, bytes long")
    assert warc.read_archives(packages).count() == 1
    with pytest.raises(Exception, match="damaged"):
        warc.read_archives(bad).collect()
