"""Media columns: types by signature, confirmed by structure.

One Aho-Corasick pass over a payload's bytes finds every known signature. For each, a validator of
the format walks its structure and lengths and gives where the object ends, or rejects it. What
starts at 0 and fills the payload is the payload's true type, whatever type was declared; what lies inside is
carved as embedded media. Work is linear in the payload but for the walks, each of which is bounded
by the object that it confirms or fails at its first broken length.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np


class Found(NamedTuple):
    kind: str
    start: int
    end: int
    body_start: int  # the samples or the compressed body, where the format has one
    body_end: int


def _png(b: bytes, at: int) -> tuple[int, int, int] | None:
    p, first = at + 8, None
    while p + 12 <= len(b):
        n, = struct.unpack_from(">I", b, p)
        name, end = b[p + 4 : p + 8], p + 12 + n
        if end > len(b) or (first is None and name != b"IHDR") or zlib.crc32(b[p + 4 : end - 4]) != struct.unpack_from(">I", b, end - 4)[0]:
            return None
        first = first or p
        if name == b"IEND":
            return end, first + 8, end - 12
        p = end
    return None


def _jpeg(b: bytes, at: int) -> tuple[int, int, int] | None:
    p, frame = at + 2, False
    while p + 4 <= len(b) and b[p] == 0xFF:
        mark, n = b[p + 1], struct.unpack_from(">H", b, p + 2)[0]
        if n < 2 or p + 2 + n > len(b):
            return None
        frame |= mark in (0xC0, 0xC1, 0xC2)
        p += 2 + n
        if mark == 0xDA:
            body, q = p, b.find(b"\xff", p)
            while q >= 0 and q + 1 < len(b) and (b[q + 1] == 0 or 0xD0 <= b[q + 1] <= 0xD7):
                q = b.find(b"\xff", q + 2)
            if q < 0 or q + 1 >= len(b):
                return None
            if b[q + 1] == 0xD9:
                return (q + 2, body, q) if frame else None
            p = q
    return None


def _gif(b: bytes, at: int) -> tuple[int, int, int] | None:
    if at + 13 > len(b):
        return None
    p = at + 13 + (3 << ((b[at + 10] & 7) + 1) if b[at + 10] & 0x80 else 0)
    body = p

    def blocks(p: int) -> int:
        while p < len(b) and b[p]:
            p += 1 + b[p]
        return p + 1

    images = 0
    while p < len(b):
        if b[p] == 0x3B:
            return (p + 1, body, p) if images else None
        if b[p] == 0x21:
            p = blocks(p + 2)
        elif b[p] == 0x2C and p + 10 < len(b):
            images += 1
            p = blocks(p + 11 + (3 << ((b[p + 9] & 7) + 1) if b[p + 9] & 0x80 else 0))
        else:
            return None
    return None


def _riff(b: bytes, at: int, form: bytes, needs: bytes, body_of: bytes) -> tuple[int, int, int] | None:
    if at + 12 > len(b) or b[at + 8 : at + 12] != form:
        return None
    end, p, seen, body = at + 8 + struct.unpack_from("<I", b, at + 4)[0], at + 12, set(), None
    if end > len(b) or end < at + 12:
        return None
    while p + 8 <= end:
        name, n = b[p : p + 4], struct.unpack_from("<I", b, p + 4)[0]
        if p + 8 + n > end:
            return None
        seen.add(name)
        if name == body_of and body is None:
            body = (p + 8, p + 8 + n)
        p += 8 + n + (n & 1)
    return (end, *body) if p in (end, end + 1) and needs in seen and body else None


def _wav(b: bytes, at: int):
    return _riff(b, at, b"WAVE", b"fmt ", b"data")


def _webp(b: bytes, at: int):
    return _riff(b, at, b"WEBP", b"VP8 ", b"VP8 ") or _riff(b, at, b"WEBP", b"VP8L", b"VP8L") or _riff(b, at, b"WEBP", b"VP8X", b"VP8X")


def _avi(b: bytes, at: int):
    return _riff(b, at, b"AVI ", b"LIST", b"LIST")


def _bmp(b: bytes, at: int) -> tuple[int, int, int] | None:
    if at + 30 > len(b):
        return None
    size, zero, offset, head, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    row = (abs(width) * bits + 31) // 32 * 4
    if zero or head not in (40, 52, 56, 108, 124) or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or offset < 14 + head or at + size > len(b) or offset + row * abs(height) > size:
        return None
    return at + size, at + offset, at + size


def _gzip(b: bytes, at: int) -> tuple[int, int, int] | None:
    if at + 18 > len(b) or b[at + 3] & 0xE0:
        return None
    reader, p = zlib.decompressobj(31), at
    try:
        while not reader.eof:  # read and thrown away piece by piece, so a large or bloated object costs neither memory nor copies of its rest
            piece = reader.unconsumed_tail or b[p : p + PIECE]
            if not piece:
                return None
            p += 0 if reader.unconsumed_tail else len(piece)
            reader.decompress(piece, 16 * PIECE)
    except zlib.error:
        return None
    end = p - len(reader.unused_data)
    return end, at + 10, end - 8


def _streamed_zip(b: bytes, at: int) -> tuple[int, int, int] | None:
    """An archive whose entries have their sizes behind them: its end is where a central directory leads back to its start."""
    e = b.find(b"PK\5\6", at)
    while 0 <= e <= len(b) - 22:
        entries, size, offset, comment = struct.unpack_from("<HIIH", b, e + 10)
        body = p = e - size
        if body - offset == at and body > at and e + 22 + comment <= len(b):
            while p + 46 <= e and b[p : p + 4] == b"PK\1\2":
                p += 46 + sum(struct.unpack_from("<HHH", b, p + 28))
                entries -= 1
            if p == e and not entries:
                return e + 22 + comment, at, body
        e = b.find(b"PK\5\6", e + 4)
    return None


def _zip(b: bytes, at: int) -> tuple[int, int, int] | None:
    p = at
    while p + 30 <= len(b) and b[p : p + 4] == b"PK\3\4":
        flags, = struct.unpack_from("<H", b, p + 6)
        packed, = struct.unpack_from("<I", b, p + 18)
        name, extra = struct.unpack_from("<HH", b, p + 26)
        if flags & 8:
            return _streamed_zip(b, at)
        if p + 30 + name + extra + packed > len(b):
            return None
        p += 30 + name + extra + packed
    body = p
    while p + 46 <= len(b) and b[p : p + 4] == b"PK\1\2":
        p += 46 + sum(struct.unpack_from("<HHH", b, p + 28))
    if p == body or p + 22 > len(b) or b[p : p + 4] != b"PK\5\6":
        return None
    end = p + 22 + struct.unpack_from("<H", b, p + 20)[0]
    return (end, at, body) if end <= len(b) else None


def _pdf(b: bytes, at: int) -> tuple[int, int, int] | None:
    if not (b[at + 5 : at + 6].isdigit() and b[at + 6 : at + 7] == b"." and b[at + 7 : at + 8].isdigit()):
        return None
    stop = b.find(b"%PDF-", at + 5)
    stop = len(b) if stop < 0 else stop
    last, table = b.rfind(b"%%EOF", at, stop), b.rfind(b"startxref", at, stop)
    return (last + 5, at + 8, last) if 0 <= table < last else None


def _ogg(b: bytes, at: int) -> tuple[int, int, int] | None:
    p = at
    while p + 27 <= len(b) and b[p : p + 5] == b"OggS\0":
        n = b[p + 26]
        end = p + 27 + n + sum(b[p + 27 : p + 27 + n])
        if end > len(b) or (p == at and not b[p + 5] & 2):
            return None
        if b[p + 5] & 4:
            return end, at, end
        p = end
    return None


def _mp4(b: bytes, at: int) -> tuple[int, int, int] | None:
    p, seen, body = at, set(), None
    while p + 8 <= len(b):
        n, name = struct.unpack_from(">I", b, p)[0], b[p + 4 : p + 8]
        head = 8
        if n == 1 and p + 16 <= len(b):
            n, head = struct.unpack_from(">Q", b, p + 8)[0], 16
        elif n == 0:
            n = len(b) - p  # to the end of the file
        if n < head or p + n > len(b) or not name.isalnum():
            break
        seen.add(name)
        body = (p + head, p + n) if name == b"mdat" else body
        p += n
    return (p, *(body or (at, p))) if {b"ftyp", b"moov"} <= seen else None


#: Bytes of a compressed object that are read at once.
PIECE = 1 << 16
#: Fixed values of the formats: type, signature, its offset from the object's start, validator.
SIGNATURES = (
    ("image/png", b"\x89PNG\r\n\x1a\n", 0, _png),
    ("image/jpeg", b"\xff\xd8\xff", 0, _jpeg),
    ("image/gif", b"GIF87a", 0, _gif),
    ("image/gif", b"GIF89a", 0, _gif),
    ("image/bmp", b"BM", 0, _bmp),
    ("image/webp", b"WEBP", 8, _webp),
    ("audio/wav", b"WAVE", 8, _wav),
    ("video/x-msvideo", b"AVI ", 8, _avi),
    ("audio/ogg", b"OggS", 0, _ogg),
    ("video/mp4", b"ftyp", 4, _mp4),
    ("application/pdf", b"%PDF-", 0, _pdf),
    ("application/zip", b"PK\3\4", 0, _zip),
    ("application/gzip", b"\x1f\x8b\x08", 0, _gzip),
)


def signature_automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for k, (_, magic, offset, _) in enumerate(SIGNATURES):
        automaton.add_word(magic.decode("latin-1"), (k, offset + len(magic) - 1))
    automaton.make_automaton()
    return automaton


def sniff(data: bytes, automaton: ahocorasick.Automaton) -> list[Found]:
    """All confirmed objects in order of start; objects inside a confirmed one's structure are listed behind it.

    An object that ends inside a shorter walk than an earlier one of the same start loses to it. Nothing
    is found in empty data.
    """
    found: dict[int, Found] = {}
    spent: dict[int, int] = {}
    for end, (k, back) in automaton.iter(data.decode("latin-1")):
        kind, _, _, validate = SIGNATURES[k]
        start = end - back
        # Pages and entries inside a confirmed object of the kind belong to it.
        if start < 0 or (kind in ("audio/ogg", "application/zip", "application/pdf") and start < spent.get(k, 0)):
            continue
        if got := validate(data, start):
            if start not in found or found[start].end < got[0]:
                found[start] = Found(kind, start, *got)
            spent[k] = max(spent.get(k, 0), got[0])
    return sorted(found.values(), key=lambda x: (x.start, -x.end))


def true_type(data: bytes, found: list[Found]) -> str:
    """The type of the object that starts the data and fills it; application/octet-stream if none does."""
    return next((x.kind for x in found if x.start == 0 and x.end >= len(data)), "application/octet-stream")


SNIFF_SCHEMA = "true_type string, corrected boolean, body_start long, body_end long, embedded array<struct<kind: string, start: long, end: long>>"


def inspect(data: bytes | None, declared: str | None, automaton: ahocorasick.Automaton) -> tuple:
    """A row of SNIFF_SCHEMA. Null data counts as empty; a null declared type counts as wrong unless the true type is unknown.

    Data is read whole, whatever its length, and equal data give equal rows. Of objects that start at one place the longest counts.
    Empty data hold nothing and are application/octet-stream.
    """
    data = data or b""
    found = sniff(data, automaton)
    kind = true_type(data, found)
    whole = next((x for x in found if x.start == 0 and x.end >= len(data)), None)
    inside = [{"kind": x.kind, "start": x.start, "end": x.end} for x in found if x is not whole]
    return kind, kind != (declared or "application/octet-stream"), whole.body_start if whole else None, whole.body_end if whole else None, inside


def carve(data: bytes, found: list[Found]) -> Iterator[tuple[str, bytes]]:
    """The embedded objects of a payload, each as a payload of its own."""
    for x in found:
        if (x.start, x.end) != (0, len(data)):
            yield x.kind, data[x.start : x.end]


def to_wav(payload: bytes, rate: int = 16_000) -> bytes:
    """The bytes as unsigned 8-bit mono samples in a RIFF/WAVE file; len(payload) must be even."""
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, rate, rate, 1, 8)
    return struct.pack("<4sI4s", b"RIFF", 4 + len(fmt) + 8 + len(payload), b"WAVE") + fmt + struct.pack("<4sI", b"data", len(payload)) + payload


def padded(text: bytes) -> bytes:
    """Zeros behind the bytes up to a positive multiple of 64."""
    return text + bytes(-len(text) % 64 or (64 if not text else 0))


def features(kind: str, samples: bytes, embedded: int) -> str:
    """Sums of the samples as whole numbers, so that equal payloads give equal strings everywhere."""
    a = np.frombuffer(samples, np.uint8)
    centred = a.astype(np.int64) - 128
    crossings = int(np.count_nonzero(np.diff(centred >= 0)))
    return f"type={kind};samples={len(a)};sum={int(a.sum(dtype=np.int64))};energy={int((centred * centred).sum())};min={int(a.min())};max={int(a.max())};crossings={crossings};embedded={embedded}"
