"""Framing of one byte range of a capture file, in one read.

A range owns the records that begin in it. The first range of a file begins
behind the file header; any other looks for a start from which ``CHAIN`` records
follow one another (plausible header fields, and in block files equal lengths at
both ends of a block). Bytes are read once, a block at a time, on to the end of the
last record; a record of any size fits, for the buffer grows to it. Only the chain of
lengths is followed record by record, all fields and frames are taken out of the
buffer by numpy.

Every range ends with a border row: records, ``sync`` (offset of its first record,
-1 if none begins in it), ``exit`` (offset behind its last record), broken records,
bytes read, and ``odd`` where a block file declares sections or interfaces behind
its first packet, so that only a walk from its start knows them."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Classic pcap magic numbers (as read little-endian) and
# their (byte order, nanosecond resolution).
MAGIC = {
    0xA1B2C3D4: ("<", False),
    0xD4C3B2A1: (">", False),
    0xA1B23C4D: ("<", True),
    0x4D3CB2A1: (">", True),
}
# Pcapng block types used.
NG_SHB, NG_IDB, NG_OPB, NG_SPB, NG_EPB = 0x0A0D0D0A, 1, 2, 3, 6
NG_BYTE_ORDER_MAGIC = 0x1A2B3C4D
GLOBAL_HEADER, RECORD_HEADER = 24, 16
CHAIN = 8
SYNC_BYTES = 64 << 10
_SYNC_STEP = 1 << 16

BORDER = "struct<records:bigint,sync:bigint,exit:bigint,broken:bigint,bytes_read:bigint,odd:boolean>"
_BORDER = pa.struct([("records", pa.int64()), ("sync", pa.int64()), ("exit", pa.int64()), ("broken", pa.int64()),
                     ("bytes_read", pa.int64()), ("odd", pa.bool_())])
FIELDS = pa.schema([("local", pa.int64()), ("ts", pa.timestamp("us", tz="UTC")), ("linktype", pa.int32()),
                    ("orig_len", pa.int32()), ("frame", pa.binary()), ("border", _BORDER)])


def local_path(path: str) -> str | None:
    if path.startswith("file:"):
        p = path[5:]
        while p.startswith("//"):
            p = p[1:]
        return p
    if "://" not in path:
        return path
    return None


def open_file(path: str):
    """Binary input for a local or remote (HDFS, S3, ...) path, and its size."""
    here = local_path(path)
    if here is not None:
        return open(here, "rb", buffering=0), os.path.getsize(here)
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(path)
    file = filesystem.open_input_file(inner)
    return file, file.size()


class Source:
    """A file that counts what is read of it."""

    def __init__(self, path: str):
        self.file, self.size = open_file(path)
        self.bytes_read = 0

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        got = bytearray()
        while len(got) < n:
            more = self.file.read(n - len(got))
            if not more:
                break
            got += more
        self.bytes_read += len(got)
        return bytes(got)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def _numbers(data: np.ndarray, at: np.ndarray, order: str, width: int = 4) -> np.ndarray:
    """The unsigned numbers of ``width`` bytes at these places."""
    if not len(at):
        return np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.as_strided(data, (len(data) - width + 1, width), (1, 1))
    return np.ascontiguousarray(windows[at]).view(f"{order}u{width}").ravel().astype(np.int64)


def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.BinaryArray:
    """The slices (in order, not overlapping) as a binary column."""
    mark = np.zeros(len(data) + 1, dtype=np.int8)
    mark[start] += 1
    mark[start + size] -= 1
    inside = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])


class _Classic:
    """Records of a classic file: sec, frac, included, original length, then the frame."""

    head = RECORD_HEADER

    def __init__(self, header: bytes):
        magic = struct.unpack("<I", header[:4])[0]
        if magic not in MAGIC:
            raise ValueError(f"not a capture file (magic {magic:#x})")
        self.order, nanos = MAGIC[magic]
        snaplen, link = struct.unpack(self.order + "II", header[16:24])
        self.link, self.per_us, self.start = link & 0x0FFFFFFF, 1000 if nanos else 1, GLOBAL_HEADER
        self.most_frac, self.most = 1_000_000 * self.per_us, max(snaplen, 65535)
        self.length_at = struct.Struct(self.order + "I").unpack_from
        self.odd = False

    def follow(self, buf: bytes, pos: int, limit: int) -> tuple[list[int], int]:
        """Starts of the whole records that begin before ``limit``, and what follows them."""
        starts, n, length_at = [], len(buf), self.length_at
        while pos < limit and pos + 16 <= n:
            after = pos + 16 + length_at(buf, pos + 8)[0]
            if after > n:
                break
            starts.append(pos)
            pos = after
        return starts, pos

    def length(self, head: bytes) -> int:
        """Bytes of the record with this head; -1 if it can't be one."""
        return 16 + self.length_at(head, 8)[0]

    def plausible(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        frac, kept, full = (_numbers(data, at + k, self.order) for k in (4, 8, 12))
        return (frac < self.most_frac) & (kept <= self.most) & (full >= kept) & (full <= 1 << 24)

    def linked(self, data: np.ndarray, starts: list[int]) -> bool:
        sec = _numbers(data, np.array(starts), self.order)
        return bool((np.abs(np.diff(sec)) <= 86_400).all())

    def batch(self, buf: bytes, starts: list[int]) -> list[pa.Array]:
        data, at = np.frombuffer(buf, np.uint8), np.array(starts)
        sec, frac, kept, full = (_numbers(data, at + k, self.order) for k in (0, 4, 8, 12))
        us = sec * 1_000_000 + frac // self.per_us
        return [pa.array(us).cast(pa.timestamp("us", tz="UTC")), pa.array(np.full(len(at), self.link, np.int32)),
                pa.array(full.astype(np.int32)), _slices(data, at + 16, kept)]


def _ticks(options: bytes, order: str) -> int:
    """Ticks per second from the options of an interface block."""
    at = 0
    while at + 4 <= len(options):
        code, length = struct.unpack_from(order + "HH", options, at)
        if code == 0:
            break
        if code == 9 and length >= 1:
            v = options[at + 4]
            return 2 ** (v & 0x7F) if v & 0x80 else 10 ** v
        at += 4 + (length + 3) // 4 * 4
    return 1_000_000


class _Blocks:
    """Blocks of a pcapng file: type, length, body, length again."""

    head = 12
    packets = (NG_EPB, NG_SPB, NG_OPB)

    def __init__(self, source: Source):
        self.order, self.interfaces, self.odd, self.start = "<", [], False, 0
        at = 0
        while at + 12 <= source.size:  # the blocks before the first packet
            head = source.read(at, 12)
            self._turn(head)
            kind, length = struct.unpack(self.order + "II", head[:8])
            if length < 12 or length % 4 or kind in self.packets or at + length > source.size:
                break
            if kind in (NG_SHB, NG_IDB):
                self._declare(kind, source.read(at, length))
            at += length
        self.known, self.start = at, 0

    def _turn(self, head: bytes) -> None:
        if struct.unpack("<I", head[:4])[0] == NG_SHB:
            self.order = "<" if struct.unpack("<I", head[8:12])[0] == NG_BYTE_ORDER_MAGIC else ">"

    def _declare(self, kind: int, block: bytes) -> None:
        if kind == NG_SHB:
            self.interfaces = []
        else:
            self.interfaces.append((struct.unpack_from(self.order + "H", block, 8)[0], _ticks(block[16:-4], self.order)))

    def follow(self, buf: bytes, pos: int, limit: int) -> tuple[list[int], int]:
        starts, n = [], len(buf)
        while pos < limit and pos + 12 <= n:
            if struct.unpack_from("<I", buf, pos)[0] == NG_SHB:
                if starts:
                    break  # byte order and interfaces change: the section has batches of its own
                self._turn(buf[pos:pos + 12])
            length = struct.unpack_from(self.order + "I", buf, pos + 4)[0]
            if length < 12 or length % 4 or pos + length > n:
                break
            starts.append(pos)
            pos += length
        return starts, pos

    def length(self, head: bytes) -> int:
        self._turn(head)
        length = struct.unpack_from(self.order + "I", head, 4)[0]
        return length if length >= 12 and length % 4 == 0 else -1

    def plausible(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        at_least = at[at + 12 <= len(data)]
        kind, length = _numbers(data, at_least, self.order), _numbers(data, at_least + 4, self.order)
        ok = ((kind < 1 << 16) & (kind > 0) | (kind == NG_SHB)) & (length >= 12) & (length % 4 == 0)
        end = at_least + length - 4
        inside = ok & (end + 4 <= len(data))
        ok[inside] &= _numbers(data, end[inside], self.order) == length[inside]
        return np.concatenate([ok, np.zeros(len(at) - len(at_least), bool)])

    def linked(self, data: np.ndarray, starts: list[int]) -> bool:
        return bool(self.plausible(data, np.array(starts)).all())

    def batch(self, buf: bytes, starts: list[int], base: int = 0) -> list[pa.Array] | None:
        data, at = np.frombuffer(buf, np.uint8), np.array(starts)
        kind, length = _numbers(data, at, self.order), _numbers(data, at + 4, self.order)
        link, rate = np.zeros(len(at), np.int64), np.ones(len(at), np.int64)
        named = np.isin(kind, (NG_EPB, NG_OPB)) & (length >= 32)
        number = np.zeros(len(at), np.int64)
        number[kind == NG_EPB] = _numbers(data, at[kind == NG_EPB] + 8, self.order)
        number[kind == NG_OPB] = _numbers(data, at[kind == NG_OPB] + 8, self.order, 2)
        declared = np.flatnonzero(np.isin(kind, (NG_SHB, NG_IDB)))
        done = 0
        for i in [*declared.tolist(), len(at)]:  # interfaces as they are known at each packet
            for n in np.unique(number[done:i]).tolist():
                here = done + np.flatnonzero(number[done:i] == n)
                link[here], rate[here] = self.interfaces[n] if n < len(self.interfaces) else (1, 1_000_000)
            if i < len(at):
                if base + int(at[i]) >= self.known:
                    self.odd = True
                    self._declare(int(kind[i]), buf[at[i]:at[i] + length[i]])
                done = i
        keep = np.flatnonzero(named | (kind == NG_SPB) & (length >= 16))
        at, kind, length, link, rate, named = at[keep], kind[keep], length[keep], link[keep], rate[keep], named[keep]
        if not len(at):
            return None
        us = np.zeros(len(at), np.int64)
        kept, full, body = length - 16, _numbers(data, at + 8, self.order), at + 12  # simple packets
        kept = np.minimum(kept, full)
        rich = at[named]
        ticks = _numbers(data, rich + 12, self.order).astype(object) * 2**32 + _numbers(data, rich + 16, self.order)
        us[named] = [int(t) * 1_000_000 // int(r) for t, r in zip(ticks, rate[named])]
        kept[named], full[named] = np.minimum(_numbers(data, rich + 20, self.order), length[named] - 32), _numbers(data, rich + 24, self.order)
        body = np.where(named, at + 28, body)
        return [pa.array(us, mask=~named).cast(pa.timestamp("us", tz="UTC")), pa.array(link.astype(np.int32)),
                pa.array(full.astype(np.int32)), _slices(data, body, kept)]


def _sync(layout, buf: bytes, upto: int, ends_here: bool) -> int:
    """The first place before ``upto`` that begins a chain of records; -1 if there is none."""
    data = np.frombuffer(buf, np.uint8)
    last = min(upto, len(buf) - layout.head + 1)
    for a in range(0, last, _SYNC_STEP):
        at = np.arange(a, min(a + _SYNC_STEP, last))
        for o in at[layout.plausible(data, at)].tolist():
            starts, pos = [], o
            while len(starts) < CHAIN and pos + layout.head <= len(buf):
                length = layout.length(buf[pos:pos + layout.head])
                if length < 0 or not layout.plausible(data, np.array([pos]))[0]:
                    break
                starts.append(pos)
                pos += length
            whole = len(starts) == CHAIN or (pos == len(buf) if ends_here else pos > len(buf) - layout.head)
            if starts and whole and layout.linked(data, starts):
                return o
    return -1


def frame_range(path: str, size: int, index: int, low: int, high: int, batch_bytes: int,
                frames: bool = True) -> Iterator[pa.RecordBatch]:
    """The records that begin in [low, high) of a file of ``size`` bytes as batches
    of ``FIELDS`` (``local`` counts from 0 in the range), the border row last;
    ``frames=False`` gives that row only."""
    with Source(path) as source:
        source.size = min(size, source.size)
        header = source.read(0, GLOBAL_HEADER)
        records, sync, end, broken, odd = 0, -1, -1, 0, False
        ng = len(header) >= 4 and struct.unpack("<I", header[:4])[0] == NG_SHB
        if ng or len(header) == GLOBAL_HEADER:
            layout = _Blocks(source) if ng else _Classic(header)
            base = low if index else layout.start
            buf = b""
            if index:
                buf = source.read(low, min(source.size - low, max(SYNC_BYTES, min(high - low, batch_bytes))))
                at = _sync(layout, buf, high - low, low + len(buf) >= source.size)
                while at < 0 and low + len(buf) < min(high, source.size):
                    buf += source.read(low + len(buf), max(len(buf), batch_bytes))
                    at = _sync(layout, buf, high - low, low + len(buf) >= source.size)
                base = low + at if at >= 0 else high
                buf = buf[at:] if at >= 0 else b""
            if base < min(high, source.size) or (not index and base <= source.size):
                sync = base
            while base < min(high, source.size):
                have = base + len(buf)
                starts, after = layout.follow(buf, 0, min(high, have) - base)
                if starts:
                    if frames or ng:
                        columns = layout.batch(buf, starts, base) if ng else layout.batch(buf, starts)
                        n = len(columns[0]) if columns else 0
                    else:
                        columns, n = None, len(starts)
                    if columns and frames:
                        yield pa.RecordBatch.from_arrays([pa.array(np.arange(records, records + n)), *columns, pa.nulls(n, _BORDER)], schema=FIELDS)
                    records += n
                    base, buf = base + after, buf[after:]
                    continue
                # the record at base isn't whole yet
                if len(buf) < layout.head:
                    want = layout.head - len(buf)
                else:
                    length = layout.length(buf[:layout.head])
                    want = length - len(buf)
                    if length < 0 or base + length > source.size:
                        broken, base = 1, source.size
                        break
                if have + want > source.size:
                    broken, base = 1, source.size
                    break
                buf += source.read(have, max(want, min(batch_bytes, high - have)))
            end, odd = base if sync >= 0 else -1, layout.odd
        border = {"records": records, "sync": sync, "exit": end, "broken": broken, "bytes_read": source.bytes_read, "odd": odd}
    yield pa.RecordBatch.from_arrays([*(pa.nulls(1, f.type) for f in list(FIELDS)[:-1]), pa.array([border], _BORDER)], schema=FIELDS)
