"""Capture source + frame decoder on byte fixtures (FIXTURES.md §2)."""

import os
import struct

import pytest
from pyspark.sql import functions as F

from pcap_fixtures import FRAMES, ether, tcp, write_pcap
from trafficlens.functions import fields
from trafficlens.operators import sample as SA
from trafficlens.sources import capture as CAP

T0 = 1_700_000_000.25


def decode(spark, root, **kw):
    frames = CAP.read_captures(spark, root, **kw)
    return {r["path"].rsplit("/", 1)[-1] + f"#{r['ordinal']}": r.asDict()
            for r in fields.packet_features(frames, keep=["path", "ordinal"]).collect()}


@pytest.fixture(scope="module")
def fixture_rows(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("caps"))
    names = list(FRAMES)
    write_pcap(os.path.join(root, "Games", "all.pcap"), [(T0 + i, FRAMES[n]) for i, n in enumerate(names)])
    rows = decode(spark, root)
    return {n: rows[f"all.pcap#{i}"] for i, n in enumerate(names)}


def test_tcp_payload(fixture_rows):
    r = fixture_rows["tcp_payload"]
    assert r["LEN_RAW"] == 20
    assert (r["Source_IP1"], r["Source_IP4"], r["Destination_IP1"]) == (10, 1, 192)
    assert (r["LEN_SRC_IP"], r["LEN_DEST_IP"]) == (8, 12)
    assert (r["TCP_SPORT"], r["TCP_DPORT"]) == (1234, 80)
    assert r["Send_Year"] == 2023 and r["Send_Second"] is not None


def test_tcp_ack_padding_not_payload(fixture_rows):
    r = fixture_rows["tcp_ack"]
    assert r["LEN_RAW"] is None and r["TCP_DPORT"] == 80


def test_udp(fixture_rows):
    r = fixture_rows["udp"]
    assert r["TCP_SPORT"] is None and r["Send_Year"] is None
    assert r["Source_IP1"] == 10 and r["LEN_RAW"] == 8


def test_ipv6_tcp(fixture_rows):
    r = fixture_rows["ipv6_tcp"]
    assert r["Source_IP1"] is None and r["Send_Year"] is None
    assert (r["TCP_SPORT"], r["TCP_DPORT"]) == (4000, 443)
    assert r["LEN_RAW"] == 4


def test_ipv6_extension_header_chains(spark):
    seg = tcp(4000, 443, b"xyz")
    options = lambda nh, units=0: bytes([nh, units]) + bytes(6 + 8 * units)
    auth = lambda nh: bytes([nh, 4]) + bytes(22)
    cut = lambda nh, offset: struct.pack("!BBHI", nh, 0, offset << 3, 9)
    chains = [(0, options(60) + options(6, 2)), (0, options(43) + options(60, 1) + options(51) + auth(6)),
              (51, auth(6)), (44, cut(6, 0)), (0, options(44) + cut(6, 0)), (44, cut(6, 5)), (60, b"\x3c")]
    rows = []
    for i, (nh, headers) in enumerate(chains):
        body = headers + (seg if i != 6 else b"")
        ip = struct.pack("!IHBB16s16s", 6 << 28, len(body), nh, 64, bytes(16), bytes(16)) + body
        rows.append((i, bytearray(ether(ip, ethertype=0x86DD, pad=False)), 1))
    got = fields.with_layers(spark.createDataFrame(rows, "i int, frame binary, linktype int"))
    got = {r["i"]: r for r in got.select("i", "_tl_tcp", "_tl_ports", "_tl_paylen").collect()}
    for i in range(5):
        assert (got[i]["_tl_tcp"], got[i]["_tl_ports"], got[i]["_tl_paylen"]) == (True, 4000 << 16 | 443, 3)
    assert (got[5]["_tl_tcp"], got[5]["_tl_paylen"]) == (False, len(seg))
    assert got[6]["_tl_tcp"] is False


def test_arp_all_null_but_class(fixture_rows):
    r = fixture_rows["arp"]
    assert r["CLASS"] == 0
    assert all(v is None for k, v in r.items() if k not in ("CLASS", "path", "ordinal"))


def test_ip_options_and_vlan(fixture_rows):
    assert (fixture_rows["options"]["TCP_SPORT"], fixture_rows["options"]["TCP_DPORT"]) == (1111, 2222)
    assert fixture_rows["options"]["LEN_RAW"] == 4
    assert (fixture_rows["vlan"]["TCP_SPORT"], fixture_rows["vlan"]["TCP_DPORT"]) == (3333, 4444)
    assert fixture_rows["vlan"]["Source_IP1"] == 10


def test_fragment_has_no_ports(fixture_rows):
    r = fixture_rows["fragment"]
    assert r["TCP_SPORT"] is None and r["Source_IP1"] == 10 and r["LEN_RAW"] == 48


def test_byte_order_and_resolution_give_same_rows(spark, tmp_path):
    frames = [(T0 + i * 0.5, FRAMES["tcp_payload"]) for i in range(5)]
    variants = {"le": {}, "be": {"big_endian": True}, "ns": {"nanos": True}}
    out = {}
    for name, kw in variants.items():
        root = str(tmp_path / name)
        write_pcap(os.path.join(root, "Music", "a.pcap"), frames, **kw)
        df = CAP.read_captures(spark, root).select("ordinal", F.unix_micros("ts").alias("us"), "frame")
        out[name] = sorted((r["ordinal"], r["us"], bytes(r["frame"])) for r in df.collect())
    assert out["le"] == out["be"] == out["ns"]
    assert out["le"][1][1] - out["le"][0][1] == 500_000


def test_truncated_and_empty(spark, tmp_path):
    root = str(tmp_path)
    write_pcap(os.path.join(root, "News", "t.pcap"), [(T0 + i, FRAMES["udp"]) for i in range(4)],
               truncate_last=True)
    write_pcap(os.path.join(root, "News", "e.pcap"), [])
    rep = {r["path"].rsplit("/", 1)[-1]: r for r in CAP.capture_report(spark, root).collect()}
    assert rep["t.pcap"]["records"] == 3 and rep["t.pcap"]["broken_records"] == 1
    assert rep["e.pcap"]["records"] == 0
    frames = CAP.read_captures(spark, root)
    assert frames.count() == 3
    assert fields.packet_features(frames).columns[0] == "CLASS"


def test_chunked_framing_keeps_order_and_prefix_sample(spark, tmp_path):
    """100 packets read in many small chunks; p = 0.2 keeps 20 (21 compat)."""
    root = str(tmp_path)
    write_pcap(os.path.join(root, "Video", "h.pcap"), [(T0 + i, FRAMES["tcp_payload"]) for i in range(100)])
    frames = CAP.read_captures(spark, root, batch_bytes=500, range_bytes=3000, partitions=7)
    rows = frames.select("ordinal", F.unix_micros("ts").alias("us"), "n_in_capture").collect()
    assert sorted(r["ordinal"] for r in rows) == list(range(100))
    assert all(r["us"] == int((T0 + r["ordinal"]) * 1e6) for r in rows)
    assert {r["n_in_capture"] for r in rows} == {100}
    assert SA.prefix_sample(frames, 20).count() == 20
    assert SA.prefix_sample(frames, 20, compat=True).count() == 21


def test_class_folders_sorted_and_blank_normalised(spark, tmp_path):
    root = str(tmp_path)
    for cls in ["Travel", "Health Fitness", "Education"]:
        write_pcap(os.path.join(root, cls, "x.pcap"), [(T0, FRAMES["arp"])])
    got = {r["class_name"]: r["CLASS"] for r in CAP.read_captures(spark, root).collect()}
    assert got == {"Education": 0, "HealthFitness": 1, "Travel": 2}


def test_layer_flags_and_extended(spark, tmp_path):
    root = str(tmp_path)
    write_pcap(os.path.join(root, "Tools", "x.pcap"), [(T0, FRAMES["tcp_payload"]), (T0 + 1, FRAMES["arp"])])
    frames = CAP.read_captures(spark, root)
    flags = {r["ordinal"]: r for r in fields.layer_flags(frames, keep=["ordinal"]).collect()}
    assert (flags[0]["has_ip"], flags[0]["has_tcp"], flags[0]["has_raw"]) == (True, True, True)
    assert (flags[1]["has_ip"], flags[1]["has_tcp"], flags[1]["has_raw"]) == (False, False, False)
    ext = {r["ordinal"]: r for r in fields.extended_features(frames, keep=["ordinal"]).collect()}
    e = ext[0]
    assert (e["VERSION"], e["IHL"], e["PROTO"], e["TTL"], e["DATAOFS"], e["TCP_FLAGS"]) == (4, 5, 6, 64, 5, 0x18)
    assert bytes(e["MESSAGE_RAW"]) == b"0123456789" and e["NAME"] == "Ethernet"
    assert e["TYPE"] == 0x0800 and e["SRC_6"] == 2 and e["DST_6"] == 1


def test_pcapng_equals_classic(spark, tmp_path):
    from pcap_fixtures import write_pcapng
    frames = [(T0 + i * 0.25, FRAMES[n]) for i, n in enumerate(["tcp_payload", "udp", "vlan", "arp"] * 5)]
    write_pcap(str(tmp_path / "a" / "Shopping" / "x.pcap"), frames)
    write_pcapng(str(tmp_path / "b" / "Shopping" / "x.pcapng"), frames)
    write_pcapng(str(tmp_path / "c" / "Shopping" / "x.pcapng"), frames, tsresol=None, simple_last=True)

    def rows(root, **kw):
        df = CAP.read_captures(spark, root, **kw)
        feats = fields.packet_features(df, keep=["ordinal", "ts"])
        return sorted(tuple(r) for r in feats.drop("ts").collect()), \
            {r["ordinal"]: r["ts"] for r in feats.collect()}

    a, ta = rows(str(tmp_path / "a"))
    b, tb = rows(str(tmp_path / "b"), batch_bytes=200, range_bytes=600, partitions=5)
    c, tc = rows(str(tmp_path / "c"))
    assert a == b and len(a) == 20
    assert ta == tb
    assert tc[19] is None and tc[3] == ta[3]
    assert [x[1:] for x in c[:19]] == [x[1:] for x in a[:19]]


def test_split_index_of_large_files_equals_whole_file_index(spark, tmp_path):
    """Files cut into many byte ranges (tiny split size): each range syncs on
    record headers; ordinals, frames and broken counts equal the whole-file
    walk. One file embeds pcap-looking records in its payloads to tempt a
    false sync — the cross-range check must still give exact results."""
    import random as _r
    rnd = _r.Random(5)
    names = list(FRAMES)
    frames = [(T0 + i * 0.01, FRAMES[rnd.choice(names)]) for i in range(300)]
    write_pcap(os.path.join(tmp_path, "Music", "a.pcap"), frames)
    write_pcap(os.path.join(tmp_path, "Music", "t.pcap"), frames[:120], truncate_last=True, big_endian=True)
    fake = b"".join(struct.pack("<IIII", 1_700_000_000 + k, 5, 4, 4) + b"abcd" for k in range(12))
    tempt = [(T0 + i, FRAMES["udp"][:42] + fake) for i in range(60)]
    write_pcap(os.path.join(tmp_path, "Music", "f.pcap"), tempt)

    def snapshot(split):
        df = CAP.read_captures(spark, str(tmp_path), range_bytes=split, batch_bytes=700, partitions=6)
        return sorted((r["path"], r["ordinal"], bytes(r["frame"]), r["n_in_capture"]) for r in df.collect())

    whole = snapshot(1 << 40)
    split = snapshot(997)
    assert split == whole
    assert len(whole) == 300 + 119 + 60
    rep_whole = {r["path"]: (r["records"], r["broken_records"]) for r in CAP.capture_report(spark, str(tmp_path)).collect()}
    rep_split = {r["path"]: (r["records"], r["broken_records"])
                 for r in CAP.capture_report(spark, str(tmp_path), range_bytes=997).collect()}
    assert rep_whole == rep_split


def framed(spark, root, **kw):
    df = CAP.read_captures(spark, str(root), **kw)
    return sorted((r["path"], r["ordinal"], r["ts"], r["linktype"], r["orig_len"], bytes(r["frame"]), r["n_in_capture"]) for r in df.collect())


def test_records_larger_than_any_buffer(spark, tmp_path):
    big = bytes(9 << 20)
    write_pcap(str(tmp_path / "Music" / "a.pcap"), [(T0, FRAMES["udp"]), (T0 + 1, big), (T0 + 2, FRAMES["arp"])])
    rows = framed(spark, tmp_path)
    assert [len(r[5]) for r in rows] == [len(FRAMES["udp"]), 9 << 20, len(FRAMES["arp"])]
    assert framed(spark, tmp_path, range_bytes=1 << 20) == rows  # whole ranges lie inside the record


def test_bytes_are_read_once(spark, tmp_path):
    from pcap_fixtures import write_pcapng
    import random as _r
    r = _r.Random(8)
    frames = [(T0 + i * 0.001, FRAMES["udp"][:42] + r.randbytes(r.randrange(20, 1400))) for i in range(6000)]
    write_pcap(str(tmp_path / "Music" / "a.pcap"), frames)
    write_pcapng(str(tmp_path / "Music" / "b.pcapng"), frames)
    report = {x["path"].rsplit("/", 1)[-1]: x for x in CAP.capture_report(spark, str(tmp_path), range_bytes=1 << 20, batch_bytes=1 << 18).collect()}
    for name in ("a.pcap", "b.pcapng"):
        size = os.path.getsize(tmp_path / "Music" / name)
        assert size > 4 << 20 and report[name]["records"] == 6000 and report[name]["broken_records"] == 0
        assert report[name]["bytes_read"] <= 1.1 * size
    rows = framed(spark, tmp_path, range_bytes=1 << 20, batch_bytes=1 << 18)
    assert [x[5] for x in rows] == [f for _, f in frames] * 2
    assert [x[1] for x in rows] == [*range(6000)] * 2


def test_block_files_in_ranges_equal_whole_files(spark, tmp_path):
    """Interfaces declared between packets, a second section of the other byte order
    and a truncated end: framed in ranges or at once, the rows are the same."""
    from pcap_fixtures import _ng_block, write_pcapng
    frames = [(T0 + i * 0.25, FRAMES[n]) for i, n in enumerate(["tcp_payload", "udp", "vlan", "arp"] * 40)]
    for name in ("a", "b", "c", "d"):
        write_pcapng(str(tmp_path / "News" / f"{name}.pcapng"), frames, tsresol=6 if name == "b" else 9, simple_last=name == "c")
    plain = (tmp_path / "News" / "a.pcapng").read_bytes()
    late = _ng_block(1, struct.pack("<HHI", 101, 0, 65535) + struct.pack("<HHB3x", 9, 1, 3) + struct.pack("<HH", 0, 0))
    raw = _ng_block(6, struct.pack("<IIIII", 1, 0, 5_000, 20, 20) + FRAMES["udp"][14:34])
    def block(kind, body):  # big-endian
        n = 12 + len(body)
        return struct.pack(">II", kind, n) + body + struct.pack(">I", n)
    other = (block(0x0A0D0D0A, struct.pack(">IHHq", 0x1A2B3C4D, 1, 0, -1)) + block(1, struct.pack(">HHI", 1, 0, 65535))
             + block(6, struct.pack(">IIIII", 0, 0, 7_000_000, 60, 60) + FRAMES["arp"]) * 3)
    (tmp_path / "News" / "e.pcapng").write_bytes(plain + late + raw * 30 + other + plain)
    (tmp_path / "News" / "f.pcapng").write_bytes(plain[:-20])
    whole = framed(spark, tmp_path, range_bytes=1 << 40)
    assert len(whole) == 160 * 4 + (160 + 30 + 3 + 160) + 159
    e = [x for x in whole if x[0].endswith("e.pcapng")]
    assert e[160][3] == 101 and e[160][2].timestamp() == 5.0 and e[190][2].timestamp() == 7.0 and e[190][5] == FRAMES["arp"]
    for size in (997, 4096, 20_000):
        assert framed(spark, tmp_path, range_bytes=size, batch_bytes=700) == whole


def test_stacked_vlan_tags(spark, tmp_path):
    inner = FRAMES["tcp_payload"]
    frames = [inner[:12] + b"".join(struct.pack("!HH", 0x8100 if i % 2 else 0x88A8, i) for i in range(n)) + inner[12:] for n in range(7)]
    write_pcap(str(tmp_path / "Tools" / "x.pcap"), [(T0 + i, f) for i, f in enumerate(frames)])
    rows = decode(spark, str(tmp_path))
    assert {(r["TCP_SPORT"], r["TCP_DPORT"], r["LEN_RAW"], r["Source_IP1"]) for r in rows.values()} == {(1234, 80, 20, 10)} and len(rows) == 7


def test_decoding_while_framing(spark, tmp_path):
    write_pcap(str(tmp_path / "Tools" / "x.pcap"), [(T0 + i, FRAMES[n]) for i, n in enumerate(list(FRAMES) * 20)])
    plain = fields.packet_features(CAP.read_captures(spark, str(tmp_path)), keep=["path", "ordinal"])
    once = CAP.read_captures(spark, str(tmp_path), range_bytes=2000, decode=fields.packet_features_of)
    assert sorted(map(str, plain.collect())) == sorted(map(str, once.select(plain.columns).collect()))
    assert {r["n_in_capture"] for r in once.collect()} == {20 * len(FRAMES)}


def test_extract_keeps_the_row_key(spark, tmp_path):
    from trafficlens.plans import jobs
    for cls in ("Games", "Music"):
        write_pcap(str(tmp_path / "in" / cls / "x.pcap"), [(T0 + i, FRAMES["tcp_payload"]) for i in range(10)])
    out = jobs.extract(spark, str(tmp_path / "in"), str(tmp_path / "out"), percent=50)
    assert sorted((r["class_name"], r["CLASS"], r["ordinal"]) for r in out.collect()) == [(c, k, i) for k, c in enumerate(("Games", "Music")) for i in range(5)]
    assert out.select("path").distinct().count() == 2
    counts, _ = jobs.profile(spark, str(tmp_path / "out"))
    assert counts.first()["columns"] == 20


def test_a_failing_writer_publishes_nothing(spark, tmp_path):
    bad = spark.createDataFrame([("A", 1, 60, bytearray(60), T0), ("A", 1, -1, bytearray(60), T0 + 1)],
                                "class_name string, linktype int, orig_len int, frame binary, t double").withColumn("ts", F.col("t").cast("timestamp"))
    with pytest.raises(Exception):
        CAP.write_captures(bad, str(tmp_path / "w"), partitions=1).count()
    assert not list((tmp_path / "w").rglob("*.pcap"))
