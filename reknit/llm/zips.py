"""ZIP packages with stored members: written as a stream, read by ranges.

Only what an archive package needs: members without compression, sizes known before, ZIP64
records wherever a size, an offset or a number of members outgrows the plain fields.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

# Fixed values of the format: signatures, and the marks of fields that ZIP64 holds.
LOCAL, CENTRAL, END = 0x04034B50, 0x02014B50, 0x06054B50
END64, LOCATOR64 = 0x06064B50, 0x07064B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
# The end record is looked for in the last bytes: its size and that of the longest comment.
TAIL = 22 + FULL16


@dataclass
class Member:
    name: str
    offset: int
    size: int
    method: int
    crc: int


class ZipWriter:
    """Members one after the other into anything with ``write``."""

    def __init__(self, out, limit: int = FULL32):
        self.out, self.limit = out, limit
        self.at = 0
        self.members: list[Member] = []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, size: int, crc: int, chunks) -> int:
        """Store a member of known size and checksum; the place where its data begins."""
        raw = name.encode()
        large = size >= self.limit
        extra = struct.pack("<HHQQ", 1, 16, size, size) if large else b""
        plain = FULL32 if large else size
        offset = self.at
        self._write(struct.pack("<IHHHHHIIIHH", LOCAL, 45 if large else 20, 0x800, 0, 0, 0x21,
                                crc, plain, plain, len(raw), len(extra)) + raw + extra)
        begin = self.at
        for chunk in chunks:
            self._write(chunk)
        if self.at - begin != size:
            raise ValueError(f"{name}: {self.at - begin} bytes instead of {size}")
        self.members.append(Member(name, offset, size, 0, crc))
        return begin

    def close(self) -> None:
        begin = self.at
        for member in self.members:
            large, far = member.size >= self.limit, member.offset >= self.limit
            extra = b"".join((struct.pack("<QQ", member.size, member.size) if large else b"",
                              struct.pack("<Q", member.offset) if far else b""))
            extra = struct.pack("<HH", 1, len(extra)) + extra if extra else b""
            plain, raw = FULL32 if large else member.size, member.name.encode()
            self._write(struct.pack(
                "<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45 if extra else 20, 0x800, 0, 0, 0x21,
                member.crc, plain, plain, len(raw), len(extra), 0, 0, 0, 0,
                FULL32 if far else member.offset) + raw + extra)
        size, count = self.at - begin, len(self.members)
        if begin >= self.limit or size >= self.limit or count >= FULL16:
            end = self.at
            self._write(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, count, count, size,
                                    begin))
            self._write(struct.pack("<IIQI", LOCATOR64, 0, end, 1))
            count, size, begin = FULL16, FULL32, FULL32
        self._write(struct.pack("<IHHHHIIH", END, 0, 0, count, count, size, begin, 0))


def members(read: Callable[[int, int], bytes], size: int) -> list[Member]:
    """The central directory of a package, by a function that reads (offset, length)."""
    start = max(0, size - TAIL)
    tail = read(start, size - start)
    place = tail.rfind(struct.pack("<I", END))
    if place < 0:
        raise ValueError("no end of a central directory")
    count, length, begin = struct.unpack_from("<HII", tail, place + 10)
    if count == FULL16 or length == FULL32 or begin == FULL32:
        locator = start + place - 20
        mark, _, end, _ = struct.unpack("<IIQI", read(locator, 20))
        if mark != LOCATOR64:
            raise ValueError("no locator of a ZIP64 directory")
        record = read(end, 56)
        if struct.unpack_from("<I", record)[0] != END64:
            raise ValueError("no ZIP64 directory")
        count, length, begin = struct.unpack_from("<QQQ", record, 32)
    directory, at, found = read(begin, length), 0, []
    for _ in range(count):
        (mark, _, _, _, method, _, _, crc, packed, plain, names, extras, comments, _, _, _,
         offset) = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
        if mark != CENTRAL:
            raise ValueError("a broken central directory")
        name = directory[at + 46:at + 46 + names].decode()
        extra = directory[at + 46 + names:at + 46 + names + extras]
        wide = _zip64(extra)
        if plain == FULL32:
            plain, wide = struct.unpack_from("<Q", wide)[0], wide[8:]
        if packed == FULL32:
            packed, wide = struct.unpack_from("<Q", wide)[0], wide[8:]
        if offset == FULL32:
            offset = struct.unpack_from("<Q", wide)[0]
        found.append(Member(name, offset, packed, method, crc))
        at += 46 + names + extras + comments
    return found


def _zip64(extra: bytes) -> bytes:
    """The ZIP64 field among the extra fields of a member."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            return extra[at + 4:at + 4 + length]
        at += 4 + length
    return b""


def data_offset(read: Callable[[int, int], bytes], member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method:
        raise ValueError(f"{member.name} is compressed, only stored members can be read by ranges")
    head = read(member.offset, 30)
    if struct.unpack_from("<I", head)[0] != LOCAL:
        raise ValueError(f"{member.name}: no local header")
    names, extras = struct.unpack_from("<HH", head, 26)
    return member.offset + 30 + names + extras


def checksum(chunks) -> tuple[int, int]:
    """Size and CRC-32 of some chunks."""
    size = crc = 0
    for chunk in chunks:
        size, crc = size + len(chunk), zlib.crc32(chunk, crc)
    return size, crc
