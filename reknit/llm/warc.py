"""WARC archives in ZIP packages: written by executors, read back by ranges.

A package holds stored members: ``archive/data.warc.gz``, each record a gzip member of its own,
and ``indexes/index.cdx``, a JSON line per record with the place and length of its bytes. The
reader goes from the end of a package to its (ZIP64) directory, finds archive and index, and
fetches runs of neighbouring records by single range reads; nothing is unpacked to disk, and
the runs of one package may be read by many tasks.

Packages lie in the shared folder, through the file system of its URI. Only what a task that
succeeded has named is read, so files that lost executors leave behind do no harm.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reknit.llm.zips import ZipWriter, checksum, data_offset, members
from reknit.session import materialize, scratch_path

# Payloads of fewer bytes are always written in full.
LEAST_REVISIT = 1000
# A package is closed when its records reach so many bytes; a task may write several.
PACKAGE_BYTES = 32_000_000
# Neighbouring records are fetched together up to so many bytes, and dealt out so.
RANGE_BYTES = 4_000_000

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
# Fixed value: the time of writing is no part of the result.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page(id: str | None) -> int | None:
    number = re.fullmatch(r"<urn:page:(-?\d+)>", id or "")
    return int(number[1]) if number else None


def record(page: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None) -> bytes:
    """A response record, or the revisit record that refers to another page."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    lines = [("WARC-Type", "response" if refers_to is None else "revisit"),
             ("WARC-Record-ID", _id(page)), ("WARC-Date", DATE)]
    if url is not None:
        # A header is one line; spaces and control characters of a URL are escaped.
        lines.append(("WARC-Target-URI", re.sub(
            r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    lines.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if refers_to is not None:
        lines.extend([("WARC-Refers-To", _id(refers_to)), ("WARC-Profile", PROFILE)])
    lines.extend([("Content-Type", "application/http; msgtype=response"),
                  ("Content-Length", str(len(block)))])
    head = "".join(f"{name}: {value}\r\n" for name, value in lines)
    return f"WARC/1.1\r\n{head}\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The parts of one record: type, page, url, refers_to, digest, stated length, payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in http.split(b"\r\n")
                  if line.lower().startswith(b"content-length:"))
    kind = fields["WARC-Type"]
    return {"type": kind, "page": _page(fields["WARC-Record-ID"]),
            "url": fields.get("WARC-Target-URI"), "refers_to": _page(fields.get("WARC-Refers-To")),
            "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "length": length,
            "payload": payload if kind == "response" else None}


def _zipped(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _planned(pages: DataFrame, id: str, url: str, payload: str) -> DataFrame:
    """(page, url, payload, digest, refers_to): which records refer to which."""
    rows = pages.select(F.col(id).cast("long").alias("page"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.encode("payload", "UTF-8")))
    large = F.octet_length("payload") >= LEAST_REVISIT
    # One row per payload that several pages share, combined map-side.
    shared = (rows.filter(large).groupBy("digest")
              .agg(F.max("page").alias("response"), F.min("page").alias("smallest"))
              .filter("response > smallest"))
    return (rows.join(shared.select("digest", "response"), "digest", "left")
            .select("page", "url", "payload", "digest",
                    F.when(large & (F.coalesce(F.col("page") != F.col("response"), F.col(
                        "response").isNotNull())), F.col("response")).alias("refers_to")))


def write_archives(pages: DataFrame, id: str = "page_id", url: str = "url",
                   payload: str = "html", folder: str | None = None) -> DataFrame:
    """Write every row as a record; the packages written: path, bytes, records.

    Of equal payloads of at least ``LEAST_REVISIT`` bytes the one of the largest id becomes the
    response, the others revisit it; rows that repeat that id with that payload are responses
    too, and so are all rows of a payload without any id. A NULL payload is an empty one, a
    NULL URL is left out.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "archives")
    planned = _planned(pages, id, url, payload)

    def write(rows: Iterator[tuple]) -> Iterator[tuple[str, int, int]]:
        system, root = fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")
        system.create_dir(root, recursive=True)
        records, index, size = [], [], 0

        def close() -> tuple[str, int, int]:
            name = f"{uuid.uuid4().hex}.wacz"
            with system.open_output_stream(f"{root}/{name}") as out:
                package = ZipWriter(out)
                package.add(ARCHIVE, *checksum(records), records)
                lines = "".join(index).encode()
                package.add(INDEX, *checksum([lines]), [lines])
                package.close()
            return f"{folder}/{name}", package.at, len(index)

        for page, address, text, digest, refers_to in rows:
            data = _zipped(record(page, address, text.encode("utf-8", "surrogatepass"), digest,
                                  refers_to))
            if records and size + len(data) > PACKAGE_BYTES:
                yield close()
                records, index, size = [], [], 0
            index.append(json.dumps({"offset": size, "length": len(data),
                                     "page": page, "digest": f"sha1:{digest}"}) + "\n")
            records.append(data)
            size += len(data)
        if records:
            yield close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = write(row for batch in batches
                      for row in zip(*(_values(column) for column in batch.columns)))
        for row in found:
            yield pa.RecordBatch.from_arrays([pa.array([value]) for value in row],
                                             names=["path", "bytes", "records"])

    return materialize(planned.mapInArrow(run, "path string, bytes long, records long"),
                       "packages")


def _values(column: pa.Array) -> Iterator:
    return (cell.as_py() for cell in column)


def _opened(path: str) -> pa.NativeFile:
    system, name = fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")
    return system.open_input_file(name)


def index_ranges(packages: DataFrame) -> DataFrame:
    """Runs of neighbouring records of all packages: path, offset, length, lengths of records."""

    def ranges(path: str, size: int) -> Iterator[tuple]:
        with _opened(path) as file:
            def read(offset: int, length: int) -> bytes:
                return file.read_at(length, offset)

            found = {member.name: member for member in members(read, size)}
            begin = data_offset(read, found[ARCHIVE])
            index = found[INDEX]
            lines = read(data_offset(read, index), index.size).decode().splitlines()
        start, lengths = begin, []
        for entry in map(json.loads, lines):
            if lengths and sum(lengths) + entry["length"] > RANGE_BYTES:
                yield path, start, lengths
                lengths = []
            if not lengths:
                start = begin + entry["offset"]
            lengths.append(entry["length"])
        if lengths:
            yield path, start, lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for name, start, lengths in ranges(path, size):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([start]), pa.array([lengths])],
                        names=["path", "start", "lengths"])

    return packages.select("path", "bytes").mapInArrow(
        run, "path string, start long, lengths array<long>")


def read_archives(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of some packages: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, and payload if ``payloads``; without it the payloads are read and checked
    all the same, but do not leave the task.

    Bytes and digest are those of the full payload: of a response as read, of a revisit as its
    HTTP header and digest line state them; its payload is NULL. A response whose digest line
    does not fit its payload is an error.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string())]
                       + [("payload", pa.binary())] * payloads)

    def rows(path: str, start: int, lengths: list[int]) -> list[tuple]:
        with _opened(path) as file:
            data = memoryview(file.read_at(sum(lengths), start))
        found, at = [], 0
        for length in lengths:
            parts = parse(zlib.decompress(data[at:at + length], 31))
            at += length
            size, digest = parts["length"], parts["digest"]
            if parts["payload"] is not None:
                size, digest = len(parts["payload"]), hashlib.sha1(parts["payload"]).hexdigest()
                if digest != parts["digest"]:
                    raise ValueError(f"{path}: the payload of page {parts['page']} is damaged")
            found.append((parts["page"], parts["url"], parts["type"], parts["refers_to"], size,
                          digest, parts["payload"])[:len(schema)])
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells in zip(*(column.to_pylist() for column in batch.columns)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, field.type) for column, field in
                     zip(zip(*rows(*cells)), schema)], schema=schema)

    return index_ranges(packages).repartition(_tasks(packages.sparkSession)).mapInArrow(
        run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
             "payload_digest string" + ", payload binary" * payloads)


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
