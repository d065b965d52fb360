"""Packet header fields as Column expressions over a framed record.

Input rows carry ``frame BINARY``, ``linktype INT`` and ``ts TIMESTAMP``
(see ``schema.FRAME_SCHEMA``). ``with_layers`` adds the layer sub-frames and
presence flags; every field is a byte read at a fixed offset of a sub-frame,
so the whole decode runs inside one whole-stage-codegen stage.

Layer presence follows the dissector the features were designed with: the IP
block needs IPv4, the TCP block needs a TCP header (IPv4 first fragment or
IPv6), the payload length counts bytes after the TCP/UDP header as given by
the IP length (so Ethernet padding never counts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import EXTENDED_INT_COLUMNS, PACKET_COLUMNS
from .bytes import uint8, uint16, uint32

# Capture link types understood by the decoder.
LINKTYPE_NULL = 0
LINKTYPE_ETHERNET = 1
LINKTYPE_RAW = 101
LINKTYPE_LINUX_SLL = 113
LINKTYPE_IPV4 = 228
LINKTYPE_IPV6 = 229
LINKTYPE_LINUX_SLL2 = 276

# Outer layer names reported in NAME.
LINKTYPE_NAMES = {
    LINKTYPE_NULL: "Loopback",
    LINKTYPE_ETHERNET: "Ethernet",
    LINKTYPE_RAW: "Raw IP",
    LINKTYPE_LINUX_SLL: "cooked linux",
    LINKTYPE_IPV4: "Raw IP",
    LINKTYPE_IPV6: "Raw IP",
    LINKTYPE_LINUX_SLL2: "cooked linux v2",
}

ETH_IPV4 = 0x0800
ETH_IPV6 = 0x86DD
ETH_VLAN = (0x8100, 0x88A8)
# IPv6 extension headers counted in 8-byte units (hop-by-hop,
# routing, destination options, mobility), fragment and authentication header.
IPV6_OPTIONS = (0, 43, 60, 135)
IPV6_FRAGMENT = 44
IPV6_AUTH = 51
RAW_LINKTYPES = (LINKTYPE_NULL, LINKTYPE_RAW, LINKTYPE_IPV4, LINKTYPE_IPV6)
_REST = 1 << 30  # "to the end of the frame" for binary substring


def _rest(b: Column, pos) -> Column:
    return F.substring(b, pos if isinstance(pos, Column) else F.lit(pos), F.lit(_REST))


_H = "_tl_"  # prefix of the helper columns added by ``with_layers``


def _h(name: str) -> Column:
    return F.col(_H + name)


def _ipv6_chain(ip: Column) -> Column:
    """(nh, pos, later) behind all IPv6 extension headers: protocol, 1-based
    start of its header, and whether this is a later fragment (nothing behind
    its fragment header is one). A header takes 8 bytes at least, so the steps
    are bounded by the packet's own length."""

    def step(s: Column, _: Column) -> Column:
        nh, pos, later = s["nh"], s["pos"], s["later"]

        def to(size: Column, fragment: Column) -> Column:
            return F.struct(uint8(ip, pos).alias("nh"), (pos + size).cast("int").alias("pos"), fragment.alias("later"))

        units = uint8(ip, pos + 1)
        cut = F.coalesce(F.shiftright(uint16(ip, pos + 2), 3) > 0, F.lit(False))
        return (F.when(later, s).when(nh.isin(*IPV6_OPTIONS), to((units + 1) * 8, later))
                .when(nh == IPV6_AUTH, to((units + 2) * 4, later))
                .when(nh == IPV6_FRAGMENT, to(F.lit(8), cut)).otherwise(s))

    start = F.struct(_h("nh").alias("nh"), F.lit(41).alias("pos"), F.lit(False).alias("later"))
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor((F.length(ip) - 40) / 8).cast("int")))
    return F.aggregate(steps, start, step)


def with_layers(df: DataFrame, frame: str = "frame", linktype: str = "linktype") -> DataFrame:
    """Add the layer helper columns ``_tl_*`` in a few small projections.

    Every later layer is a *sub-frame* (``_tl_ip`` starts at the IP header,
    ``_tl_l4`` at the transport header), so each field is a read at a fixed
    offset of one sub-frame. Each stage is its own projection: Catalyst
    keeps them apart (their outputs are expensive and used many times), so
    the plan stays small and every expression is computed once per row."""
    fr, lt = F.col(frame), F.col(linktype)
    ethernet = lt == LINKTYPE_ETHERNET
    raw = lt.isin(*RAW_LINKTYPES)
    # tags beyond the third are counted one by one, to the frame's end
    deep = F.aggregate(F.sequence(F.lit(3), F.greatest(F.lit(3), F.floor((F.length(fr) - 14) / 4).cast("int"))), F.lit(3),
                       lambda n, k: F.when((n == k) & F.coalesce(uint16(fr, k * 4 + 13).isin(*ETH_VLAN), F.lit(False)), n + 1).otherwise(n))
    nvlan = F.lit(0)
    for tags, more in ((2, deep), (1, None), (0, None)):
        inner = more if more is not None else nvlan
        nvlan = F.when(uint16(fr, tags * 4 + 13).isin(*ETH_VLAN), inner).otherwise(F.lit(tags))
    df = df.withColumns({_H + "nvlan": F.when(ethernet, nvlan)})

    l3pos = (F.when(ethernet, _h("nvlan") * 4 + 15)
             .when(lt == LINKTYPE_NULL, F.lit(5))
             .when(raw, F.lit(1))
             .when(lt == LINKTYPE_LINUX_SLL, F.lit(17))
             .when(lt == LINKTYPE_LINUX_SLL2, F.lit(21)))
    ethertype = (F.when(ethernet, uint16(fr, _h("nvlan") * 4 + 13))
                 .when(lt == LINKTYPE_LINUX_SLL, uint16(fr, 15))
                 .when(lt == LINKTYPE_LINUX_SLL2, uint16(fr, 1)))
    df = df.withColumns({_H + "ip": _rest(fr, l3pos), _H + "eth": ethertype})

    # the first three 32-bit words of the IP header, each read once:
    # w0 = version|ihl, tos, total length (v6: version, class, flow)
    # w1 = id, flags|fragment (v6: payload length, next header, hop limit)
    # w2 = ttl, protocol, checksum
    ip = _h("ip")
    df = df.withColumns({_H + "w0": uint32(ip, 1), _H + "w1": uint32(ip, 5), _H + "w2": uint32(ip, 9)})
    w0, w1 = _h("w0"), _h("w1")
    version = F.shiftright(w0, 28)
    ihl = F.shiftright(w0, 24).bitwiseAND(15)
    df = df.withColumns({
        _H + "v4": F.coalesce((raw | (_h("eth") == ETH_IPV4)) & (version == 4) & (ihl >= 5)
                              & (F.length(ip) >= 20), F.lit(False)),
        _H + "v6": F.coalesce((raw | (_h("eth") == ETH_IPV6)) & (version == 6)
                              & (F.length(ip) >= 40), F.lit(False)),
        _H + "ver": version.cast("int"), _H + "ihl": ihl.cast("int"),
        _H + "nh": F.shiftright(w1, 8).bitwiseAND(255).cast("int"),
        _H + "frag": w1.bitwiseAND(0x1FFF).cast("int"),
    })

    v4, v6 = _h("v4"), _h("v6")
    ext = v6 & _h("nh").isin(*IPV6_OPTIONS, IPV6_FRAGMENT, IPV6_AUTH)
    df = df.withColumns({_H + "chain": F.when(ext, _ipv6_chain(ip))})
    chain = _h("chain")
    v6later = F.coalesce(chain["later"], F.lit(False))
    proto = (F.when(v4, F.shiftright(_h("w2"), 16).bitwiseAND(255).cast("int"))
             .when(v6, F.when(ext, chain["nh"]).otherwise(_h("nh"))))
    # 1-based start of the transport header inside the IP sub-frame
    l4start = (F.when(v4, _h("ihl") * 4 + 1)
               .when(v6, F.when(ext, chain["pos"]).otherwise(F.lit(41))))
    total4, plen6 = _h("w0").bitwiseAND(0xFFFF), F.shiftright(_h("w1"), 16)
    # IP length from layer 3 on: a captured frame can be shorter (snap
    # length) or longer (Ethernet padding) than the IP packet, so the payload
    # is what both allow; a zero length field (segmentation offload) falls
    # back to the captured bytes
    iplen = (F.when(v4, F.when(total4 > 0, F.least(total4, F.length(ip))).otherwise(F.length(ip)))
             .when(v6, F.when(plen6 > 0, F.least(plen6 + 40, F.length(ip))).otherwise(F.length(ip))))
    df = df.withColumns({_H + "proto": proto, _H + "l4start": l4start, _H + "iplen": iplen})

    l4 = _rest(ip, _h("l4start"))
    first = F.when(v4, _h("frag") == 0).when(v6, ~v6later)
    df = df.withColumns({
        _H + "l4": l4,
        _H + "tcp": F.coalesce(first & (_h("proto") == 6) & (F.length(l4) >= 20), F.lit(False)),
        _H + "udp": F.coalesce(first & (_h("proto") == 17) & (F.length(l4) >= 8), F.lit(False)),
        _H + "later": (v4 & (_h("frag") > 0)) | v6later,
    })

    tcp, udp = _h("tcp"), _h("udp")
    l4hdr = (F.when(tcp, F.shiftright(uint8(_h("l4"), 13), 4) * 4)
             .when(udp, F.lit(8)).otherwise(F.lit(0)))
    df = df.withColumns({_H + "l4hdr": l4hdr})
    # payload bytes after the transport header (all of a later fragment)
    paylen = F.when(tcp | udp | _h("later"), _h("iplen") - _h("l4start") + 1 - _h("l4hdr"))
    # packed words read once here: the sealed output below does not share
    # subexpressions, so each is computed in this stage
    return df.withColumns({_H + "paylen": paylen, _H + "src": uint32(ip, 13), _H + "dst": uint32(ip, 17),
                           _H + "ports": uint32(_h("l4"), 1)})


def drop_layers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(_H)])


def _octets(word: Column) -> list[Column]:
    """The four bytes of a 32-bit word, most significant first."""
    return [F.shiftright(word, 24 - 8 * i).bitwiseAND(255) for i in range(4)]


def dotted_length(o1: Column, o2: Column, o3: Column, o4: Column) -> Column:
    """Length of the dotted-quad text of four octets (7..15): three dots plus
    the decimal digits of each octet, by arithmetic (no strings built)."""
    digits = [F.lit(1) + (o >= 10).cast("int") + (o >= 100).cast("int") for o in (o1, o2, o3, o4)]
    return digits[0] + digits[1] + digits[2] + digits[3] + 3


def ip_text_octets(text: Column) -> list[Column]:
    """Parse dotted IPv4 text into four octets; anything that is not four
    decimal parts in 0..255 gives four nulls."""
    parts = F.split(text, r"\.")
    valid = text.rlike(r"^([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})$")
    octs = [F.try_element_at(parts, F.lit(i + 1)).try_cast("int") for i in range(4)]
    ok = valid
    for o in octs:
        ok = ok & o.between(0, 255)
    # leading zeros ("01") are rejected, as by standard address parsers
    for i in range(4):
        p = F.try_element_at(parts, F.lit(i + 1))
        ok = ok & ((F.length(p) == 1) | ~p.startswith("0"))
    return [F.when(ok, o) for o in octs]


_DAY_US = 86_400_000_000


def utc_parts(t: Column) -> tuple[Column, ...]:
    """(day, year, month, day of month, hour, minute, second) of a timestamp
    in UTC, floored to the second, from epoch microseconds — independent of
    the session time zone (the original used the machine's zone)."""
    us = F.unix_micros(t)
    sod_us = F.pmod(us, F.lit(_DAY_US))
    day = ((us - sod_us) / F.lit(_DAY_US)).cast("bigint")
    date = F.date_from_unix_date(day.cast("int"))
    sod = F.floor(sod_us / F.lit(1_000_000)).cast("int")
    return (day, F.year(date), F.month(date), F.dayofmonth(date),
            (sod / 3600).cast("int"), (F.pmod(sod, F.lit(3600)) / 60).cast("int"), F.pmod(sod, F.lit(60)))


def packet_feature_columns(ts: str = "ts") -> dict[str, Column]:
    """The 19 feature columns (CLASS excluded), over ``with_layers`` output."""
    t = F.col(ts)
    v4, tcp = _h("v4"), _h("tcp")
    cols: dict[str, Column] = {}
    src = _octets(_h("src"))
    dst = _octets(_h("dst"))
    cols["LEN_SRC_IP"] = F.when(v4, dotted_length(*src))
    cols["LEN_DEST_IP"] = F.when(v4, dotted_length(*dst))
    for i in range(4):
        cols[f"Source_IP{i + 1}"] = F.when(v4, src[i])
    for i in range(4):
        cols[f"Destination_IP{i + 1}"] = F.when(v4, dst[i])
    ports = _h("ports")
    cols["TCP_SPORT"] = F.when(tcp, F.shiftright(ports, 16))
    cols["TCP_DPORT"] = F.when(tcp, ports.bitwiseAND(0xFFFF))
    # hex length of the payload = 2 x bytes; null when there is none
    cols["LEN_RAW"] = F.when(_h("paylen") > 0, _h("paylen") * 2)
    ip_tcp = v4 & tcp
    day, year, month, dom, hour, minute, second = utc_parts(t)
    cols["Send_Year"] = F.when(ip_tcp, year)
    cols["Send_Month"] = F.when(ip_tcp, month)
    cols["Send_Day"] = F.when(ip_tcp, dom)
    cols["Send_Hour"] = F.when(ip_tcp, hour)
    cols["Send_Minute"] = F.when(ip_tcp, minute)
    cols["Send_Second"] = F.when(ip_tcp, second)
    return {k: v.cast("int") for k, v in cols.items()}


def with_extended_words(df: DataFrame, frame: str = "frame") -> DataFrame:
    """Words the extended table slices, read once per row (after
    ``with_layers``): the 12 MAC bytes as three words, the ethertype, and
    the four TCP words after the ports."""
    fr, l4 = F.col(frame), _h("l4")
    return df.withColumns({
        _H + "m0": uint32(fr, 1), _H + "m1": uint32(fr, 5), _H + "m2": uint32(fr, 9),
        _H + "type": uint16(fr, 13),
        _H + "t0": uint32(l4, 5), _H + "t1": uint32(l4, 9), _H + "t2": uint32(l4, 13), _H + "t3": uint32(l4, 17),
    })


def extended_columns(frame: str = "frame", ts: str = "ts", linktype: str = "linktype") -> dict[str, Column]:
    """Extended header fields over ``with_layers`` + ``with_extended_words``."""
    v4, tcp = _h("v4"), _h("tcp")
    eth = F.col(linktype) == LINKTYPE_ETHERNET
    mac = _octets(_h("m0")) + _octets(_h("m1")) + _octets(_h("m2"))
    cols: dict[str, Column] = {}
    cols["VERSION"] = F.when(v4 & tcp, _h("ver"))  # like IHL, read with a TCP header only
    cols["IHL"] = F.when(v4 & tcp, _h("ihl"))
    for i in range(6):
        cols[f"DST_{i + 1}"] = F.when(eth, mac[i])
    for i in range(6):
        cols[f"SRC_{i + 1}"] = F.when(eth, mac[6 + i])
    cols["TYPE"] = F.when(eth, _h("type"))
    w0, w1, w2 = _h("w0"), _h("w1"), _h("w2")
    cols["LEN"] = F.when(v4, w0.bitwiseAND(0xFFFF))
    cols["ID"] = F.when(v4, F.shiftright(w1, 16))
    cols["IP_FLAGS"] = F.when(v4, F.shiftright(w1, 13).bitwiseAND(7))
    cols["FRAG"] = F.when(v4, _h("frag"))
    cols["TTL"] = F.when(v4, F.shiftright(w2, 24))
    cols["PROTO"] = F.when(v4, F.shiftright(w2, 16).bitwiseAND(255))
    cols["CHKSUM"] = F.when(v4, w2.bitwiseAND(0xFFFF))
    t2, t3 = _h("t2"), _h("t3")
    cols["DATAOFS"] = F.when(tcp, F.shiftright(t2, 28))
    cols["RESERVED"] = F.when(tcp, F.shiftright(t2, 25).bitwiseAND(7))
    cols["TCP_FLAGS"] = F.when(tcp, F.shiftright(t2, 16).bitwiseAND(511))
    cols["WINDOW"] = F.when(tcp, t2.bitwiseAND(0xFFFF))
    cols["CHKSUM_"] = F.when(tcp, F.shiftright(t3, 16))
    cols["URGPTR"] = F.when(tcp, t3.bitwiseAND(0xFFFF))
    out = {k: v.cast("int") for k, v in cols.items()}
    assert list(out) == EXTENDED_INT_COLUMNS
    out["SEQ"] = F.when(tcp, _h("t0"))
    out["ACK"] = F.when(tcp, _h("t1"))
    out["MESSAGE_RAW"] = F.when(_h("paylen") > 0, F.substring(_h("l4"), _h("l4hdr") + 1, _h("paylen")))
    out["TIME_TCP"] = F.when(v4 & tcp, F.date_trunc("second", F.col(ts)))
    name = None
    for code, text in LINKTYPE_NAMES.items():
        cond = F.col(linktype) == code
        name = F.when(cond, F.lit(text)) if name is None else name.when(cond, F.lit(text))
    out["NAME"] = name
    return out


def tcp_flag_letters(flags: Column) -> Column:
    """Letters of the set TCP flags, low bit first (F S R P A U E C N)."""
    # Flag letters by bit, bit 0 first.
    letters = ["F", "S", "R", "P", "A", "U", "E", "C", "N"]
    parts = [F.when(flags.bitwiseAND(1 << i) != 0, F.lit(ch)).otherwise(F.lit(""))
             for i, ch in enumerate(letters)]
    return F.when(flags.isNotNull(), F.concat(*parts))


def sealed(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """Select ``keep`` plus ``columns`` through a one-element generator.

    Predicates on the decoded columns then stay above the decoder (they are
    evaluated on its output, once per row) instead of being pushed below it
    with the whole decode inlined into the filter; predicates on ``keep``
    columns still reach the scan."""
    return df.select(*keep, F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))))


def packet_features(df: DataFrame, class_col: str = "CLASS", frame: str = "frame",
                    ts: str = "ts", linktype: str = "linktype", keep: list[str] | None = None) -> DataFrame:
    """Framed records (with a CLASS column) → the 20-column packet table,
    in canonical column order; ``keep`` carries extra columns through."""
    feats = packet_feature_columns(ts)
    cols = {"CLASS": F.col(class_col).cast("int")}
    cols.update((c, feats[c]) for c in PACKET_COLUMNS[1:])
    return sealed(with_layers(df, frame, linktype), list(keep or []), cols)


def packet_features_of(frames: DataFrame, keep: list[str]) -> DataFrame:
    """``packet_features`` for readers that decode while they frame."""
    return packet_features(frames, keep=keep)


def extended_features_of(frames: DataFrame, keep: list[str]) -> DataFrame:
    return extended_features(frames, keep=keep)


def extended_features(df: DataFrame, class_col: str = "CLASS", frame: str = "frame",
                      ts: str = "ts", linktype: str = "linktype", keep: list[str] | None = None) -> DataFrame:
    feats = packet_feature_columns(ts)
    ext = extended_columns(frame, ts, linktype)
    base = {"CLASS": F.col(class_col).cast("int")}
    base.update((c, feats[c]) for c in PACKET_COLUMNS[1:])
    staged = with_extended_words(with_layers(df, frame, linktype), frame)
    helpers = [c for c in staged.columns if c.startswith(_H)] + [frame, ts, linktype]
    keep = list(keep or [])
    # three smaller seals instead of one: each generated method stays small
    # enough for the JIT
    out = sealed(staged, keep + helpers, base)
    out = sealed(out, keep + helpers + PACKET_COLUMNS, {k: ext[k] for k in EXTENDED_INT_COLUMNS})
    rest = {k: v for k, v in ext.items() if k not in EXTENDED_INT_COLUMNS}
    return sealed(out, keep + PACKET_COLUMNS + EXTENDED_INT_COLUMNS, rest)


def layer_flags(df: DataFrame, frame: str = "frame", linktype: str = "linktype",
                keep: list[str] | None = None) -> DataFrame:
    """Layer predicates: has_ip (IPv4), has_tcp, has_raw (a payload)."""
    return sealed(with_layers(df, frame, linktype), list(keep or []),
                  {"has_ip": _h("v4"), "has_tcp": _h("tcp"),
                   "has_raw": F.coalesce(_h("paylen") > 0, F.lit(False))})
