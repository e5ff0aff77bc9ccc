"""The container format of microscopes' exports (HDF5), as far as images need it: groups, chunked and contiguous datasets, attributes.

Reading is by seek: superblocks of versions 0 to 3, object headers of both versions, groups by symbol tables or by links in the header,
chunks through their tree, deflated or shuffled. Writing: chunks stand wherever they were put; `closing` gives the bytes of all
metadata for a place behind them and the superblock. Signatures, codes of messages and sizes are fixed values of the format.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import numpy as np

SIGNATURE, UNDEFINED = b"\x89HDF\r\n\x1a\n", 0xFFFFFFFFFFFFFFFF
SPACE, TYPE, FILL_OLD, FILL, LINK, LAYOUT, FILTERS, ATTRIBUTE, MORE, GROUP = 1, 3, 4, 5, 6, 8, 11, 12, 16, 17
DEFLATE, SHUFFLE = 1, 2
#: Entries of a node of the tree of chunks where the superblock does not say otherwise.
CHUNK_NODE = 64


def _padded(n: int) -> int:
    return -(-n // 8) * 8


def _type(raw: bytes) -> np.dtype:
    """A number type, or bytes of a length for texts."""
    kind, bits, size = raw[0] & 15, raw[1], struct.unpack_from("<I", raw, 4)[0]
    order = ">" if bits & 1 else "<"
    if kind == 0:
        return np.dtype(f"{order}{'i' if bits & 8 else 'u'}{size}")
    if kind == 1:
        return np.dtype(f"{order}f{size}")
    if kind == 3:
        return np.dtype(f"S{size}")
    raise ValueError(f"data of class {kind} are not read")


def _space(raw: bytes) -> tuple[int, ...]:
    at = 8 if raw[0] == 1 else 4
    return struct.unpack_from(f"<{raw[1]}Q", raw, at)


@dataclass
class Dataset:
    """What a dataset's header says. chunk is None where the data stand in one piece at `at`, or, if they are in the header, in `inline`."""

    shape: tuple[int, ...]
    kind: np.dtype
    at: int = UNDEFINED
    chunk: tuple[int, ...] | None = None
    filters: tuple[int, ...] = ()
    inline: bytes | None = None


class Container:
    """An open file."""

    def __init__(self, f: BinaryIO):
        self.f = f
        base = self._read(0, 96)
        if base[:8] != SIGNATURE:
            raise ValueError("not a container of this format")
        version = base[8]
        if version < 2:
            if base[13] != 8 or base[14] != 8:
                raise ValueError("offsets of other than 8 bytes are not read")
            root = 24 + (4 if version == 1 else 0) + 32
            self.root = struct.unpack_from("<Q", base, root + 8)[0]
        else:
            self.root = struct.unpack_from("<Q", base, 36)[0]

    def _read(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)

    # -- headers --

    def messages(self, at: int) -> Iterator[tuple[int, bytes]]:
        """(code, body) of an object's messages."""
        head = self._read(at, 16)
        if head[:4] == b"OHDR":
            yield from self._messages_new(at, head)
            return
        blocks = [(at + 16, struct.unpack_from("<I", head, 8)[0])]
        while blocks:
            start, size = blocks.pop(0)
            raw, k = self._read(start, size), 0
            while k + 8 <= len(raw):
                code, n = struct.unpack_from("<HH", raw, k)
                body = raw[k + 8 : k + 8 + n]
                k += 8 + n
                if code == MORE:
                    blocks.append(struct.unpack("<QQ", body[:16]))
                else:
                    yield code, body

    def _messages_new(self, at: int, head: bytes) -> Iterator[tuple[int, bytes]]:
        flags = head[5]
        k = 6 + (16 if flags & 32 else 0) + (4 if flags & 16 else 0)
        wide = 1 << (flags & 3)
        blocks = [(at + k + wide, int.from_bytes(self._read(at + k, wide), "little"))]
        extra = 2 if flags & 4 else 0
        while blocks:
            start, size = blocks.pop(0)
            raw, k = self._read(start, size), 0
            while k + 4 + extra <= len(raw):
                code, n = struct.unpack_from("<BH", raw, k)
                body = raw[k + 4 + extra : k + 4 + extra + n]
                k += 4 + extra + n
                if code == MORE:
                    place, length = struct.unpack("<QQ", body[:16])
                    blocks.append((place + 4, length - 8))  # without signature and checksum
                else:
                    yield code, body

    # -- groups --

    def children(self, at: int) -> dict[str, int]:
        """Names and headers of what a group holds; nothing for a dataset."""
        out: dict[str, int] = {}
        for code, body in self.messages(at):
            if code == GROUP:
                tree, heap = struct.unpack("<QQ", body[:16])
                names = struct.unpack_from("<Q", self._read(heap, 32), 24)[0]
                self._symbols(tree, names, out)
            elif code == LINK:
                name, place = _link(body)
                if place is not None:
                    out[name] = place
        return out

    def _symbols(self, at: int, names: int, out: dict[str, int]) -> None:
        head = self._read(at, 24)
        if head[:4] == b"SNOD":
            n = struct.unpack_from("<H", head, 6)[0]
            raw = self._read(at + 8, 40 * n)
            for k in range(n):
                name, place = struct.unpack_from("<QQ", raw, 40 * k)
                out[self._name(names + name)] = place
            return
        used = struct.unpack_from("<H", head, 6)[0]
        raw = self._read(at + 24, 16 * used + 8)
        for k in range(used):
            self._symbols(struct.unpack_from("<Q", raw, 16 * k + 8)[0], names, out)

    def _name(self, at: int) -> str:
        raw = b""
        while b"\0" not in raw:
            more = self._read(at + len(raw), 64)
            if not more:
                break
            raw += more
        return raw.split(b"\0")[0].decode()

    def find(self, path: str) -> int | None:
        """The header of an object, or nothing."""
        at = self.root
        for name in filter(None, path.split("/")):
            found = self.children(at).get(name)
            if found is None:
                return None
            at = found
        return at

    def datasets(self, at: int | None = None, path: str = "") -> Iterator[tuple[str, Dataset]]:
        """Every dataset with its path, in order of names."""
        at = self.root if at is None else at
        own = self.dataset(at)
        if own is not None:
            yield path, own
            return
        for name, place in sorted(self.children(at).items()):
            yield from self.datasets(place, f"{path}/{name}" if path else name)

    # -- datasets --

    def dataset(self, at: int) -> Dataset | None:
        """The dataset of a header; nothing for a group."""
        found: dict[int, bytes] = {}
        for code, body in self.messages(at):
            found.setdefault(code, body)
        if LAYOUT not in found:
            return None
        d = Dataset(_space(found[SPACE]), _type(found[TYPE]))
        raw = found[LAYOUT]
        if raw[0] != 3:
            raise ValueError(f"data layout of version {raw[0]} is not read")
        if raw[1] == 0:
            d.inline = raw[4 : 4 + struct.unpack_from("<H", raw, 2)[0]]
        elif raw[1] == 1:
            d.at = struct.unpack_from("<Q", raw, 2)[0]
        else:
            rank = raw[2] - 1
            d.at = struct.unpack_from("<Q", raw, 3)[0]
            d.chunk = struct.unpack_from(f"<{rank}I", raw, 11)
        d.filters = _filters(found.get(FILTERS))
        return d

    def chunks(self, d: Dataset, first: tuple[int, ...], last: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], int, int, int]]:
        """(offsets, place, bytes, filters left out) of the chunks there are, in order, from one chunk's offsets up to another's (inclusive)."""
        if d.at != UNDEFINED:
            yield from self._chunks(d, d.at, first, last)

    def _chunks(self, d: Dataset, at: int, first: tuple[int, ...], last: tuple[int, ...]) -> Iterator[tuple]:
        rank = len(d.shape)
        head = self._read(at, 24)
        level, used = head[5], struct.unpack_from("<H", head, 6)[0]
        key = 8 + 8 * (rank + 1)
        raw = self._read(at + 24, used * (key + 8) + key)
        offsets = [struct.unpack_from(f"<{rank}Q", raw, k * (key + 8) + 8) for k in range(used + 1)]
        for k in range(used):
            place = struct.unpack_from("<Q", raw, k * (key + 8) + key)[0]
            if level:
                # A node holds keys from its own up to, without, the next one's; the last key may be anything beyond.
                if offsets[k] <= last and (k + 1 == used or offsets[k + 1] > first):
                    yield from self._chunks(d, place, first, last)
            elif first <= offsets[k] <= last:
                size, mask = struct.unpack_from("<II", raw, k * (key + 8))
                yield offsets[k], place, size, mask

    def block(self, d: Dataset, place: int, size: int, mask: int) -> np.ndarray:
        """The decoded chunk."""
        raw = self._read(place, size)
        for k in reversed(range(len(d.filters))):
            if mask >> k & 1:
                continue
            if d.filters[k] == DEFLATE:
                raw = zlib.decompress(raw)
            else:
                raw = np.frombuffer(raw, np.uint8).reshape(d.kind.itemsize, -1).T.tobytes()
        return np.frombuffer(raw, d.kind).reshape(d.chunk)

    def whole(self, d: Dataset) -> np.ndarray:
        """A small dataset, all of it."""
        if d.inline is not None:
            return np.frombuffer(d.inline, d.kind)[: int(np.prod(d.shape))].reshape(d.shape)
        if d.chunk is None:
            n = int(np.prod(d.shape))
            return np.zeros(d.shape, d.kind) if d.at == UNDEFINED else np.frombuffer(self._read(d.at, n * d.kind.itemsize), d.kind).reshape(d.shape)
        out = np.zeros(d.shape, d.kind)
        for offsets, place, size, mask in self.chunks(d, (0,) * len(d.shape), d.shape):
            block = self.block(d, place, size, mask)
            at = tuple(slice(o, o + c) for o, c in zip(offsets, d.chunk))
            out[at] = block[tuple(slice(0, n) for n in out[at].shape)]
        return out

    def attributes(self, at: int) -> dict[str, np.ndarray]:
        """The attributes of an object that are numbers or texts of fixed length."""
        out = {}
        for code, raw in self.messages(at):
            if code != ATTRIBUTE:
                continue
            version = raw[0]
            n, t, s = struct.unpack_from("<HHH", raw, 2)
            pad = _padded if version == 1 else (lambda v: v)
            k = 9 if version == 3 else 8
            name = raw[k : k + n].split(b"\0")[0].decode()
            k += pad(n)
            try:
                kind = _type(raw[k : k + t])
            except ValueError:
                continue
            k += pad(t)
            shape = _space(raw[k : k + s])
            k += pad(s)
            out[name] = np.frombuffer(raw, kind, int(np.prod(shape)) if shape else 1, k).reshape(shape)
        return out


def _link(raw: bytes) -> tuple[str, int | None]:
    """A link in a header: its name, and the header it leads to if it is a hard link."""
    flags, k, kind = raw[1], 2, 0
    if flags & 8:
        kind, k = raw[k], k + 1
    k += (8 if flags & 4 else 0) + (1 if flags & 16 else 0)
    wide = 1 << (flags & 3)
    n = int.from_bytes(raw[k : k + wide], "little")
    k += wide
    return raw[k : k + n].decode(), struct.unpack_from("<Q", raw, k + n)[0] if kind == 0 else None


def _filters(raw: bytes | None) -> tuple[int, ...]:
    if raw is None:
        return ()
    out, k = [], 8 if raw[0] == 1 else 2
    for _ in range(raw[1]):
        code = struct.unpack_from("<H", raw, k)[0]
        named = raw[0] == 1 or code >= 256
        name = struct.unpack_from("<H", raw, k + 2)[0] if named else 0
        k += 4 if named else 2
        many = struct.unpack_from("<H", raw, k + 2)[0]
        k += 4 + (_padded(name) if raw[0] == 1 else name) + 4 * (many + (many % 2 if raw[0] == 1 else 0))
        if code not in (DEFLATE, SHUFFLE):
            raise ValueError(f"filter {code} is not read")
        out.append(code)
    return tuple(out)


# --- writing -----------------------------------------------------------------------------------------------------


@dataclass
class Node:
    """A group, with children and attributes, or a dataset, with its index of chunks or its whole bytes."""

    children: dict[str, Node] = field(default_factory=dict)
    attributes: dict[str, str | np.ndarray] = field(default_factory=dict)
    shape: tuple[int, ...] | None = None
    kind: np.dtype | None = None
    chunk: tuple[int, ...] | None = None
    index: list[tuple[tuple[int, ...], int, int]] = field(default_factory=list)  # chunk offsets, place, bytes
    data: bytes = b""

    def at(self, path: str) -> Node:
        """The node of a path, made where it is not there."""
        node = self
        for name in filter(None, path.split("/")):
            node = node.children.setdefault(name, Node())
        return node


def _type_message(kind: np.dtype) -> bytes:
    if kind.kind in "ui":
        return struct.pack("<B3BIHH", 0x10, 8 if kind.kind == "i" else 0, 0, 0, kind.itemsize, 0, kind.itemsize * 8)
    if kind.kind == "f":
        parts = {4: (31, 23, 8, 0, 23, 127), 8: (63, 52, 11, 0, 52, 1023)}[kind.itemsize]
        return struct.pack("<B3BIHHBBBBI", 0x11, 0x20, parts[0], 0, kind.itemsize, 0, kind.itemsize * 8, *parts[1:])
    return struct.pack("<B3BI", 0x13, 0, 0, 0, kind.itemsize)


def _space_message(shape: tuple[int, ...]) -> bytes:
    return struct.pack("<BBB5x", 1, len(shape), 0) + struct.pack(f"<{len(shape)}Q", *shape)


def _header(messages: list[tuple[int, bytes]]) -> bytes:
    body = b"".join(struct.pack("<HHB3x", code, _padded(len(raw)), 0) + raw.ljust(_padded(len(raw)), b"\0") for code, raw in messages)
    return struct.pack("<BBHII4x", 1, 0, len(messages), 1, len(body)) + body


def _attribute(name: str, value: str | np.ndarray) -> bytes:
    value = np.array(value.encode()) if isinstance(value, str) else np.asarray(value)
    label, kind, space = name.encode() + b"\0", _type_message(value.dtype), _space_message(value.shape)
    head = struct.pack("<BBHHH", 1, 0, len(label), len(kind), len(space))
    return head + b"".join(x.ljust(_padded(len(x)), b"\0") for x in (label, kind, space)) + value.tobytes()


class _Tail:
    """Metadata that grow from a place on."""

    def __init__(self, start: int):
        self.start, self.out, self.leaf = start, bytearray(), 4

    def put(self, raw: bytes) -> int:
        self.out += b"\0" * (-len(self.out) % 8)
        at = self.start + len(self.out)
        self.out += raw
        return at

    def tree(self, rank: int, chunk: tuple[int, ...], index: list[tuple[tuple[int, ...], int, int]]) -> int:
        """The tree of a dataset's chunks; leaves first."""
        if not index:
            return UNDEFINED
        key = lambda offsets, size: struct.pack("<II", size, 0) + struct.pack(f"<{rank + 1}Q", *offsets, 0)
        beyond = tuple(o + c for o, c in zip(max(index)[0], chunk))
        rows, level = [(offsets, size, place) for offsets, place, size in sorted(index)], 0
        whole = 24 + CHUNK_NODE * (8 + 8 + 8 * (rank + 1)) + 8 + 8 * (rank + 1)
        while True:
            groups = [rows[k : k + CHUNK_NODE] for k in range(0, len(rows), CHUNK_NODE)]
            self.out += b"\0" * (-len(self.out) % 8)
            first = self.start + len(self.out)
            step, up = _padded(whole), []
            for k, g in enumerate(groups):
                after = rows[(k + 1) * CHUNK_NODE][0] if k + 1 < len(groups) else beyond
                left = first + (k - 1) * step if k else UNDEFINED
                right = first + (k + 1) * step if k + 1 < len(groups) else UNDEFINED
                raw = struct.pack("<4sBBHQQ", b"TREE", 1, level, len(g), left, right) + b"".join(key(o, n) + struct.pack("<Q", p) for o, n, p in g) + key(after, 0)
                up.append((g[0][0], g[0][1], self.put(raw.ljust(step, b"\0"))))
            if len(up) == 1:
                return up[0][2]
            rows, level = up, level + 1

    def node(self, n: Node) -> int:
        """An object and all below it; the place of its header."""
        notes = [(ATTRIBUTE, _attribute(k, v)) for k, v in n.attributes.items()]
        if n.shape is not None:
            messages = [(SPACE, _space_message(n.shape)), (TYPE, _type_message(n.kind)), (FILL, struct.pack("<BBBB", 2, 3 if n.chunk else 2, 0, 0))]
            if n.chunk is None:
                place = self.put(n.data) if n.data else UNDEFINED
                messages.append((LAYOUT, struct.pack("<BBQQ", 3, 1, place, len(n.data))))
            else:
                rank = len(n.shape)
                layout = struct.pack("<BBBQ", 3, 2, rank + 1, self.tree(rank, n.chunk, n.index)) + struct.pack(f"<{rank + 1}I", *n.chunk, n.kind.itemsize)
                messages += [(FILTERS, struct.pack("<BB6xHHHHI4x", 1, 1, DEFLATE, 0, 0, 1, 6)), (LAYOUT, layout)]
            return self.put(_header(messages + notes))
        names, offsets = bytearray(8), {}
        for name in sorted(n.children):
            offsets[name] = len(names)
            names += name.encode().ljust(_padded(len(name.encode()) + 1), b"\0")
        entries = b"".join(struct.pack("<QQII16x", offsets[name], self.node(n.children[name]), 0, 0) for name in sorted(n.children))
        symbols = self.put((struct.pack("<4sBBH", b"SNOD", 1, 0, len(n.children)) + entries).ljust(8 + 80 * self.leaf, b"\0"))
        tree = struct.pack("<4sBBHQQ", b"TREE", 0, 0, 1, UNDEFINED, UNDEFINED) + struct.pack("<QQQ", 0, symbols, max(offsets.values(), default=0))
        tree = self.put(tree.ljust(24 + 33 * 8 + 32 * 8, b"\0"))
        heap = self.put(struct.pack("<4sB3xQQQ", b"HEAP", 0, len(names), 1, self.put(bytes(names))))
        return self.put(_header([(GROUP, struct.pack("<QQ", tree, heap)), *notes]))


def _widest(n: Node) -> int:
    return max([len(n.children), *map(_widest, n.children.values())])


#: Chunks stand behind this place.
START = 2048


def closing(root: Node, end: int) -> tuple[bytes, bytes]:
    """The superblock, and the metadata for the place `end` (a multiple of 8) behind all chunks."""
    tail = _Tail(end)
    tail.leaf = max(4, -(-_widest(root) // 2))
    top = tail.node(root)
    head = SIGNATURE + struct.pack("<8BHHI", 0, 0, 0, 0, 0, 8, 8, 0, tail.leaf, 16, 0)
    head += struct.pack("<QQQQ", 0, UNDEFINED, end + len(tail.out), UNDEFINED) + struct.pack("<QQII16x", 0, top, 0, 0)
    return head, bytes(tail.out)


def packed_block(block: np.ndarray) -> bytes:
    """A chunk, deflated."""
    return zlib.compress(np.ascontiguousarray(block).tobytes(), 6)
