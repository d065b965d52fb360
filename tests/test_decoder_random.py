"""Randomised frames: the Column decoder against a small struct-based
parser written independently here."""

import random
import struct

from pyspark.sql import types as T

from trafficlens.functions import fields


def make_frame(rnd: random.Random):
    vlan = rnd.random() < 0.2
    kind = rnd.choice(["tcp", "tcp", "udp", "icmp", "arp", "ipv6"])
    ihl = rnd.choice([5, 5, 5, 6, 8])
    frag = rnd.choice([0, 0, 0, 0x4000, 0x2000 | 37, 90])
    payload = bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 0, 1, 7, 60, 300])))
    src = [rnd.randrange(256) for _ in range(4)]
    dst = [rnd.randrange(256) for _ in range(4)]
    sport, dport = rnd.randrange(65536), rnd.randrange(65536)
    if kind == "arp":
        body, etype = bytes(28), 0x0806
    elif kind == "ipv6":
        seg = struct.pack("!HHIIBBHHH", sport, dport, 1, 2, 0x50, 0x18, 100, 0, 0) + payload
        body = struct.pack("!IHBB16s16s", 6 << 28, len(seg), 6, 64, bytes(16), bytes(16)) + seg
        etype = 0x86DD
    else:
        if kind == "tcp":
            l4 = struct.pack("!HHIIBBHHH", sport, dport, 7, 9, 0x50, 0x18, 1000, 0, 0) + payload
            proto = 6
        elif kind == "udp":
            l4 = struct.pack("!HHHH", sport, dport, 8 + len(payload), 0) + payload
            proto = 17
        else:
            l4 = struct.pack("!BBHHH", 8, 0, 0, 1, 1) + payload
            proto = 1
        hdr = struct.pack("!BBHHHBBH4s4s", 0x40 | ihl, 0, ihl * 4 + len(l4), 1, frag, 64, proto, 0,
                          bytes(src), bytes(dst)) + bytes((ihl - 5) * 4)
        body, etype = hdr + l4, 0x0800
    tag = struct.pack("!HH", 0x8100, 5) if vlan else b""
    frame = bytes(6) + bytes(6) + tag + struct.pack("!H", etype) + body
    if len(frame) < 60:
        frame += bytes(60 - len(frame))
    if rnd.random() < 0.05:
        frame = frame[: rnd.randrange(14, len(frame))]  # truncated capture
    return frame


def expected(frame: bytes) -> dict:
    """Independent parse with struct (Ethernet, one VLAN tag, IPv4/IPv6)."""
    out = {k: None for k in ("v4", "sport", "dport", "raw", "s1", "lsrc")}
    off = 12
    etype = struct.unpack_from("!H", frame, off)[0]
    off += 2
    if etype == 0x8100:
        if len(frame) < off + 4:
            return out
        etype = struct.unpack_from("!H", frame, off + 2)[0]
        off += 4
    ip = frame[off:]
    if etype == 0x0800 and len(ip) >= 20 and ip[0] >> 4 == 4 and ip[0] & 15 >= 5:
        ihl = (ip[0] & 15) * 4
        total, flags_frag, proto = struct.unpack_from("!H", ip, 2)[0], struct.unpack_from("!H", ip, 6)[0], ip[9]
        out["v4"] = True
        out["s1"] = ip[12]
        out["lsrc"] = len(".".join(str(b) for b in ip[12:16]))
        l4 = ip[ihl:]
        fragoff = flags_frag & 0x1FFF
        iplen = min(total, len(ip)) if total else len(ip)
        if fragoff == 0 and proto == 6 and len(l4) >= 20:
            out["sport"], out["dport"] = struct.unpack_from("!HH", l4, 0)
            n = iplen - ihl - (l4[12] >> 4) * 4
        elif fragoff == 0 and proto == 17 and len(l4) >= 8:
            n = iplen - ihl - 8
        elif fragoff > 0:
            n = iplen - ihl
        else:
            n = 0
        out["raw"] = 2 * n if n > 0 else None
    elif etype == 0x86DD and len(ip) >= 40 and ip[0] >> 4 == 6:
        plen, nh = struct.unpack_from("!H", ip, 4)[0], ip[6]
        l4 = ip[40:]
        iplen = min(plen + 40, len(ip)) if plen else len(ip)
        if nh == 6 and len(l4) >= 20:
            out["sport"], out["dport"] = struct.unpack_from("!HH", l4, 0)
            n = iplen - 40 - (l4[12] >> 4) * 4
            out["raw"] = 2 * n if n > 0 else None
    return out


def test_random_frames_match_independent_parser(spark):
    rnd = random.Random(20241202)
    frames = [make_frame(rnd) for _ in range(3000)]
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("frame", T.BinaryType()),
                           T.StructField("linktype", T.IntegerType()), T.StructField("ts", T.TimestampType()),
                           T.StructField("CLASS", T.IntegerType())])
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, f, 1, t, 0) for i, f in enumerate(frames)], schema)
    got = {r["i"]: r for r in fields.packet_features(df, keep=["i"]).collect()}
    flags = {r["i"]: r for r in fields.layer_flags(df, keep=["i"]).collect()}
    bad = []
    for i, f in enumerate(frames):
        e, g = expected(f), got[i]
        pairs = [(bool(e["v4"]), flags[i]["has_ip"]), (e["sport"], g["TCP_SPORT"]),
                 (e["dport"], g["TCP_DPORT"]), (e["raw"], g["LEN_RAW"]), (e["s1"], g["Source_IP1"]),
                 (e["lsrc"], g["LEN_SRC_IP"])]
        if any(a != b for a, b in pairs):
            bad.append((i, pairs))
    assert not bad, bad[:5]
