"""DuckDB twins of the registered queries.

Expected packet fields are computed from the construction rules directly
(not by decoding bytes), so a decoder bug cannot hide in both engines.
Views available: the driver's tables (events, ...)."""

from __future__ import annotations

CTE_EV = """
ev AS (
  SELECT e.*, (dense_rank() OVER (ORDER BY event_type) - 1)::INTEGER AS CLASS
  FROM events e
)"""

CTE_RULE = CTE_EV + """,
rule AS (
  SELECT ev.*,
    event_id % 50 <> 0 AS has_ip,
    event_id % 50 <> 0 AND event_id % 10 <> 7 AS is_tcp,
    event_id % 50 <> 0 AND event_id % 10 = 7 AS is_udp,
    CASE WHEN event_id % 7 = 3 THEN 6 ELSE 5 END AS ihl,
    CASE WHEN event_id % 3 = 0 THEN 0 ELSE CLASS * 100 + floor(value)::BIGINT % 150 END AS plen,
    10 + (user_id % 3) * 81 AS s1, user_id % 256 AS s2, (event_id // 256) % 256 AS s3, event_id % 256 AS s4,
    (event_id * 13) % 224 AS d1, (user_id * 7) % 256 AS d2, event_id % 100 AS d3, (event_id + user_id) % 256 AS d4,
    (event_id * 37) % 60000 + 1024 AS sport,
    CASE WHEN event_id % 10 = 7 THEN CLASS + 5000 WHEN event_id % 5 = 0 THEN 443 ELSE CLASS + 8000 END AS dport,
    (event_id * 2654435761) % 4294967296 AS seq, (user_id * 40503 + event_id * 7) % 4294967296 AS ack,
    (event_id * 101) % 65536 AS win, (event_id * 3) % 65536 AS tcp_chk,
    event_id % 65536 AS ip_id, user_id % 64 + 32 AS ttl, (event_id * 7) % 65536 AS ip_chk,
    ts AS pts,
    'capture-' || user_id::VARCHAR || '.pcap' AS path
  FROM ev
)"""

# Expected 20-column packet table plus event_id.
CTE_PK = CTE_RULE + """,
pk AS (
  SELECT event_id, user_id, path, ts, event_type AS class_name,
    CLASS::INTEGER AS CLASS,
    (CASE WHEN has_ip THEN length(concat_ws('.', s1, s2, s3, s4)) END)::INTEGER AS LEN_SRC_IP,
    (CASE WHEN has_ip THEN length(concat_ws('.', d1, d2, d3, d4)) END)::INTEGER AS LEN_DEST_IP,
    (CASE WHEN has_ip THEN s1 END)::INTEGER AS Source_IP1,
    (CASE WHEN has_ip THEN s2 END)::INTEGER AS Source_IP2,
    (CASE WHEN has_ip THEN s3 END)::INTEGER AS Source_IP3,
    (CASE WHEN has_ip THEN s4 END)::INTEGER AS Source_IP4,
    (CASE WHEN has_ip THEN d1 END)::INTEGER AS Destination_IP1,
    (CASE WHEN has_ip THEN d2 END)::INTEGER AS Destination_IP2,
    (CASE WHEN has_ip THEN d3 END)::INTEGER AS Destination_IP3,
    (CASE WHEN has_ip THEN d4 END)::INTEGER AS Destination_IP4,
    (CASE WHEN is_tcp THEN sport END)::INTEGER AS TCP_SPORT,
    (CASE WHEN is_tcp THEN dport END)::INTEGER AS TCP_DPORT,
    (CASE WHEN has_ip AND plen > 0 THEN 2 * plen END)::INTEGER AS LEN_RAW,
    (CASE WHEN is_tcp THEN year(pts) END)::INTEGER AS Send_Year,
    (CASE WHEN is_tcp THEN month(pts) END)::INTEGER AS Send_Month,
    (CASE WHEN is_tcp THEN day(pts) END)::INTEGER AS Send_Day,
    (CASE WHEN is_tcp THEN hour(pts) END)::INTEGER AS Send_Hour,
    (CASE WHEN is_tcp THEN minute(pts) END)::INTEGER AS Send_Minute,
    (CASE WHEN is_tcp THEN second(pts) END)::INTEGER AS Send_Second,
    has_ip, is_tcp, is_udp, ihl, plen, seq, ack, win, tcp_chk, ip_id, ttl, ip_chk, dport, sport
  FROM rule
)"""

PACKET_COLS = ("CLASS, LEN_SRC_IP, LEN_DEST_IP, Source_IP1, Source_IP2, Source_IP3, Source_IP4, "
               "Destination_IP1, Destination_IP2, Destination_IP3, Destination_IP4, TCP_SPORT, TCP_DPORT, "
               "LEN_RAW, Send_Year, Send_Month, Send_Day, Send_Hour, Send_Minute, Send_Second")
FEATURE_LIST = [c.strip() for c in PACKET_COLS.split(",")][1:]


def with_pk(body: str) -> str:
    return "WITH " + CTE_PK + "\n" + body
