"""Byte-level capture fixtures written with ``struct`` into a fresh folder."""

from __future__ import annotations

import os
import struct


def mac(a: int) -> bytes:
    return bytes([2, 0, 0, 0, 0, a])


def ipv4(src, dst, proto, payload: bytes, ihl=5, frag=0, ident=1, ttl=64, total=None) -> bytes:
    opts = b"\x01" * ((ihl - 5) * 4)
    length = total if total is not None else ihl * 4 + len(payload)
    hdr = struct.pack("!BBHHHBBH4s4s", 0x40 | ihl, 0, length, ident, frag, ttl, proto, 0,
                      bytes(src), bytes(dst))
    return hdr + opts + payload


def tcp(sport, dport, payload=b"", flags=0x18, seq=1, ack=2, window=512) -> bytes:
    return struct.pack("!HHIIBBHHH", sport, dport, seq, ack, 5 << 4, flags, window, 0, 0) + payload


def udp(sport, dport, payload=b"") -> bytes:
    return struct.pack("!HHHH", sport, dport, 8 + len(payload), 0) + payload


def ether(payload: bytes, ethertype=0x0800, vlan=None, pad=True) -> bytes:
    tag = struct.pack("!HH", 0x8100, vlan) if vlan is not None else b""
    f = mac(1) + mac(2) + tag + struct.pack("!H", ethertype) + payload
    if pad and len(f) < 60:
        f += b"\x00" * (60 - len(f))
    return f


def ipv6_tcp(payload=b"") -> bytes:
    seg = tcp(4000, 443, payload)
    hdr = struct.pack("!IHBB16s16s", 6 << 28, len(seg), 6, 64, b"\x20" + b"\x00" * 15, b"\x20" + b"\x01" * 15)
    return ether(hdr + seg, ethertype=0x86DD)


SRC, DST = [10, 0, 0, 1], [192, 168, 1, 20]

FRAMES = {
    "tcp_payload": ether(ipv4(SRC, DST, 6, tcp(1234, 80, b"0123456789"))),
    "tcp_ack": ether(ipv4(SRC, DST, 6, tcp(1234, 80, b"", flags=0x10))),
    "udp": ether(ipv4(SRC, DST, 17, udp(5353, 53, b"abcd"))),
    "ipv6_tcp": ipv6_tcp(b"xy"),
    "arp": ether(bytes(28), ethertype=0x0806),
    "options": ether(ipv4(SRC, DST, 6, tcp(1111, 2222, b"zz"), ihl=6)),
    "vlan": ether(ipv4(SRC, DST, 6, tcp(3333, 4444, b"q")), vlan=7),
    "fragment": ether(ipv4(SRC, DST, 6, b"\x00" * 24, frag=100)),
}


def write_pcap(path: str, frames: list[tuple[float, bytes]], big_endian=False, nanos=False,
               linktype=1, truncate_last=False) -> None:
    order = ">" if big_endian else "<"
    magic = 0xA1B23C4D if nanos else 0xA1B2C3D4
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(struct.pack(order + "IHHiIII", magic, 2, 4, 0, 0, 65535, linktype))
        for i, (ts, body) in enumerate(frames):
            sec = int(ts)
            frac = int(round((ts - sec) * (1e9 if nanos else 1e6)))
            rec = struct.pack(order + "IIII", sec, frac, len(body), len(body)) + body
            if truncate_last and i == len(frames) - 1:
                rec = rec[: 16 + len(body) // 2]
            f.write(rec)


def _ng_block(btype: int, body: bytes) -> bytes:
    body += b"\x00" * ((4 - len(body) % 4) % 4)
    n = 12 + len(body)
    return struct.pack("<II", btype, n) + body + struct.pack("<I", n)


def write_pcapng(path: str, frames: list[tuple[float, bytes]], tsresol: int | None = 9,
                 simple_last: bool = False) -> None:
    """One section, one Ethernet interface (nanosecond stamps by default),
    enhanced packet blocks (the last one a simple packet block if asked)."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    shb = _ng_block(0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1))
    opts = b""
    if tsresol is not None:
        opts = struct.pack("<HHB3x", 9, 1, tsresol) + struct.pack("<HH", 0, 0)
    idb = _ng_block(1, struct.pack("<HHI", 1, 0, 65535) + opts)
    res = 10 ** (tsresol if tsresol is not None else 6)
    out = [shb, idb]
    for i, (ts, body) in enumerate(frames):
        if simple_last and i == len(frames) - 1:
            out.append(_ng_block(3, struct.pack("<I", len(body)) + body))
            continue
        sec = int(ts)
        ticks = sec * res + int(round((ts - sec) * res))
        out.append(_ng_block(6, struct.pack("<IIIII", 0, ticks >> 32, ticks & 0xFFFFFFFF, len(body), len(body)) + body))
    with open(path, "wb") as f:
        f.write(b"".join(out))
