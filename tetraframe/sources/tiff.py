"""The TIFF format, page by page: directories and strips are read by seek, pages are encoded for files beyond 4 GB.

Strips and tiles may be plain, deflated or LZW, with or without the horizontal predictor; samples are whole or floating numbers of
8 to 64 bits, one a pixel. Numbers of tags and codes are fixed values of the format.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np

#: Struct letters of the field types that are read, by code; fixed values.
FIELDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 11: "f", 12: "d", 16: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, DESCRIPTION, STRIPS, SAMPLES, ROWS, STRIP_BYTES = 256, 257, 258, 259, 262, 270, 273, 277, 278, 279
X_RES, Y_RES, UNIT, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT = 282, 283, 296, 317, 322, 323, 324, 325, 339
PLAIN, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946
CODES = {"none": PLAIN, "lzw": LZW, "zlib": DEFLATE}


class Layout:
    """Byte order and sizes of a file's directories."""

    def __init__(self, f: BinaryIO):
        f.seek(0)
        head = f.read(16)
        if head[:2] not in (b"II", b"MM"):
            raise ValueError("not a TIFF file")
        self.order = "<" if head[:2] == b"II" else ">"
        self.big = struct.unpack(self.order + "H", head[2:4])[0] == 43
        self.count, self.entry, self.offset = ("Q", 20, "Q") if self.big else ("H", 12, "I")
        self.first = struct.unpack(self.order + self.offset, head[8:16] if self.big else head[4:8])[0]

    def _one(self, f: BinaryIO, at: int, letter: str) -> int:
        f.seek(at)
        return struct.unpack(self.order + letter, f.read(struct.calcsize(letter)))[0]

    def directories(self, f: BinaryIO) -> list[int]:
        """Where each page's directory stands; only counts and links are read."""
        out, at = [], self.first
        while at:
            out.append(at)
            n = self._one(f, at, self.count)
            at = self._one(f, at + struct.calcsize(self.count) + n * self.entry, self.offset)
            if len(out) > 1 << 24:
                raise ValueError("directories of a TIFF file run in a circle")
        return out

    def tags(self, f: BinaryIO, at: int) -> dict:
        """The tags of the directory at a place, by number; rationals stay pairs of numbers."""
        n = self._one(f, at, self.count)
        body, tags = f.read(n * self.entry), {}
        for k in range(n):
            tag, kind, many = struct.unpack_from(self.order + "HH" + self.offset, body, k * self.entry)
            letters = FIELDS.get(kind)
            if letters is None:
                continue
            form = f"{self.order}{many}s" if letters == "s" else self.order + letters * many
            inline = k * self.entry + (12 if self.big else 8)
            raw = body[inline : inline + struct.calcsize(form)]
            if struct.calcsize(form) > (8 if self.big else 4):
                f.seek(struct.unpack_from(self.order + self.offset, body, inline)[0])
                raw = f.read(struct.calcsize(form))
            v = struct.unpack(form, raw)
            tags[tag] = v[0].split(b"\0")[0].decode("latin-1") if letters == "s" else v
        return tags


def described(text: str | None) -> dict[str, str]:
    """key=value lines of an image description."""
    return dict(line.strip().split("=", 1) for line in (text or "").splitlines() if "=" in line)


class Pages:
    """The pages of an open file: how many, their time points and slices, and each one's pixels when asked for."""

    def __init__(self, f: BinaryIO):
        self.f, self.layout = f, Layout(f)
        self.at = self.layout.directories(f)
        self.head = self.layout.tags(f, self.at[0]) if self.at else {}
        text = described(self.head.get(DESCRIPTION))
        whole = lambda key, default: int(text[key]) if text.get(key, "").isdigit() else default
        # One directory that names more images is followed by all of them, plain and without gaps.
        images = whole("images", 1) if len(self.at) == 1 else 1
        if images > 1 and self.head.get(COMPRESSION, (1,))[0] != PLAIN:
            raise ValueError(f"one directory names {images} images, which only plain pages allow")
        self.follow = images > 1
        self.count = images if self.follow else len(self.at)
        depth = whole("slices", self.count)
        self.depth = depth if depth * whole("frames", 1) == self.count else self.count

    def kind(self, tags: dict) -> np.dtype:
        if tags.get(SAMPLES, (1,))[0] != 1:
            raise ValueError("pages of several samples a pixel are not read")
        letter = {2: "i", 3: "f"}.get(tags.get(FORMAT, (1,))[0], "u")
        return np.dtype(f"{self.layout.order}{letter}{tags[BITS][0] // 8}")

    def _part(self, tags: dict, at: int, size: int, shape: tuple[int, int], kind: np.dtype) -> np.ndarray:
        """One strip or tile."""
        self.f.seek(at)
        raw = self.f.read(size)
        packing = tags.get(COMPRESSION, (1,))[0]
        if packing == LZW:
            raw = unlzw(raw)
        elif packing in (DEFLATE, OLD_DEFLATE):
            raw = zlib.decompress(raw)
        elif packing != PLAIN:
            raise ValueError(f"TIFF compression {packing} is not read")
        rows = min(shape[0], len(raw) // (shape[1] * kind.itemsize))
        out = np.frombuffer(raw, kind, rows * shape[1]).reshape(rows, shape[1])
        predictor = tags.get(PREDICTOR, (1,))[0]
        if predictor == 2:
            out = np.cumsum(out, axis=1, dtype=kind.newbyteorder("="))
        elif predictor != 1:
            raise ValueError(f"TIFF predictor {predictor} is not read")
        return out

    def pixels(self, page: int) -> np.ndarray:
        """(y, x) of a page."""
        tags = self.head if self.follow else self.layout.tags(self.f, self.at[page])
        kind, shape = self.kind(tags), (tags[HEIGHT][0], tags[WIDTH][0])
        if self.follow:
            size = shape[0] * shape[1] * kind.itemsize
            return self._part(tags, tags[STRIPS][0] + page * size, size, shape, kind)
        out = np.zeros(shape, kind.newbyteorder("="))
        if TILES in tags:
            th, tw = tags[TILE_HEIGHT][0], tags[TILE_WIDTH][0]
            across = -(-shape[1] // tw)
            for k, (at, size) in enumerate(zip(tags[TILES], tags[TILE_BYTES])):
                y, x = k // across * th, k % across * tw
                tile = self._part(tags, at, size, (th, tw), kind)
                out[y : y + th, x : x + tw] = tile[: shape[0] - y, : shape[1] - x]
            return out
        rows = min(tags.get(ROWS, (shape[0],))[0], shape[0])
        for k, (at, size) in enumerate(zip(tags[STRIPS], tags[STRIP_BYTES])):
            y = k * rows
            out[y : y + rows] = self._part(tags, at, size, (min(rows, shape[0] - y), shape[1]), kind)
        return out


# --- LZW ---------------------------------------------------------------------------------------------------------

_CLEAR, _END = 256, 257
#: Codes between two clear codes, and the bits of the k-th of them: the table outgrows 9, 10, 11 bits one code early.
_RUN = 3837
_BITS = np.array([9 if k < 254 else 10 if k < 766 else 11 if k < 1790 else 12 for k in range(_RUN + 3)])
_AT = np.concatenate([[0], np.cumsum(_BITS)])


def _codes(data: np.ndarray, bit: int) -> np.ndarray:
    """The codes from a bit on, as many as a table can take and the data hold. data: with three bytes to spare."""
    n = int(np.searchsorted(_AT, (len(data) - 3) * 8 - bit, "right")) - 1
    place, wide = bit + _AT[: min(n, len(_BITS))], _BITS[:n]
    byte = place >> 3
    three = data[byte].astype(np.int64) << 16 | data[byte + 1].astype(np.int64) << 8 | data[byte + 2]
    return three >> (24 - wide - (place & 7)) & ((1 << wide) - 1)


def unlzw(raw: bytes) -> bytes:
    """What an LZW strip holds: codes are taken from the bits a table at a time; a code's string is a slice of what came before."""
    data, bit, out = np.frombuffer(raw + b"\0\0\0", np.uint8), 0, bytearray()
    while True:
        codes = _codes(data, bit)
        stop = np.flatnonzero((codes == _CLEAR) | (codes == _END))
        n = int(stop[0]) if len(stop) else len(codes)
        begin: list[int] = []
        for code in codes[:n].tolist():
            now = len(out)
            begin.append(now)
            if code < 256:
                out.append(code)
                continue
            a, b = begin[code - 258], begin[code - 257] + 1
            # The string made just now ends with its own first byte.
            out += out[a:b] if b <= now else out[a:now] + out[a : a + 1]
        if not len(stop) or codes[n] == _END:
            return bytes(out)
        bit += int(_AT[n + 1])


def lzw(data: bytes) -> bytes:
    """data as an LZW strip."""
    codes, groups = [], []
    table: dict[bytes, int] = {}
    now = b""

    def close(last: int) -> None:
        codes.append(last)
        values, wide = np.array(codes), _BITS[: len(codes)]
        bits = (values[:, None] >> (wide[:, None] - 1 - np.arange(12)) & 1).astype(np.uint8)
        groups.append(bits[np.arange(12) < wide[:, None]])
        codes.clear()
        table.clear()

    close(_CLEAR)
    for k in range(len(data)):
        more = now + data[k : k + 1]
        if len(more) == 1 or more in table:
            now = more
            continue
        codes.append(table[now] if len(now) > 1 else now[0])
        table[more] = 257 + len(codes)
        now = data[k : k + 1]
        if len(codes) == _RUN - 1:
            close(_CLEAR)
    if now:
        codes.append(table[now] if len(now) > 1 else now[0])
    close(_END)
    return np.packbits(np.concatenate(groups)).tobytes()


# --- encoding ----------------------------------------------------------------------------------------------------


def packed_page(page: np.ndarray, compression: str = "zlib", predictor: bool = False) -> bytes:
    """A page as one strip."""
    little = np.ascontiguousarray(page, page.dtype.newbyteorder("<"))
    if predictor:
        little = np.diff(little, axis=1, prepend=little.dtype.type(0))
    raw = little.tobytes()
    return zlib.compress(raw, 6) if compression == "zlib" else lzw(raw) if compression == "lzw" else raw


#: Bytes of the header of a file whose offsets have 64 bits; the first directory follows it.
HEADER = struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16)


def directory(at: int, after: int, shape: tuple[int, int], kind: np.dtype, size: int, compression: str, predictor: bool, text: str = "", resolution: tuple[float, float, int] | None = None) -> bytes:
    """The directory at a place, with its description; the page's strip stands right behind it. after: the next directory, or 0. resolution: pixels a unit for x and y, and the unit's code."""
    comment = text.encode("latin-1") + b"\0" if text else b""
    entries = [(WIDTH, 4, 1, shape[1]), (HEIGHT, 4, 1, shape[0]), (BITS, 3, 1, kind.itemsize * 8), (COMPRESSION, 3, 1, CODES[compression]), (PHOTOMETRIC, 3, 1, 1)]
    entries += [(STRIPS, 16, 1, 0), (SAMPLES, 3, 1, 1), (ROWS, 4, 1, shape[0]), (STRIP_BYTES, 16, 1, size), (FORMAT, 3, 1, {"u": 1, "i": 2, "f": 3}[kind.kind])]
    if predictor:
        entries.append((PREDICTOR, 3, 1, 2))
    if comment:
        entries.append((DESCRIPTION, 2, len(comment), 0))
    if resolution is not None:
        scale = 1_000_000 if max(resolution[:2]) < 4000 else 1000 if max(resolution[:2]) < 4_000_000 else 1
        rational = lambda v: round(v * scale) | scale << 32
        entries += [(X_RES, 5, 1, rational(resolution[0])), (Y_RES, 5, 1, rational(resolution[1])), (UNIT, 3, 1, resolution[2])]
    behind = at + 8 + 20 * len(entries) + 8
    short = len(comment) <= 8
    place = {STRIPS: behind + (0 if short else len(comment)), DESCRIPTION: int.from_bytes(comment.ljust(8, b"\0"), "little") if short else behind}
    body = b"".join(struct.pack("<HHQQ", tag, field, many, place.get(tag, v)) for tag, field, many, v in sorted(entries))
    return struct.pack("<Q", len(entries)) + body + struct.pack("<Q", after) + (b"" if short else comment)


def file_of_pages(pages: Iterator[np.ndarray], compression: str = "zlib", predictor: bool = False, text: str = "", resolution: tuple[float, float, int] | None = None) -> bytes:
    """A whole small file, as the sink writes large ones."""
    out, pages = bytearray(HEADER), list(pages)
    for k, page in enumerate(pages):
        data = packed_page(page, compression, predictor)
        head = lambda after: directory(len(out), after, page.shape, page.dtype, len(data), compression, predictor, text if k == 0 else "", resolution)  # noqa: B023, E731
        size = len(head(0)) + len(data)
        out += head(len(out) + size if k + 1 < len(pages) else 0) + data
    return bytes(out)
