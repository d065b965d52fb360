"""Table shapes shared by every job: packet features, framed records, samples."""

from __future__ import annotations

from pyspark.sql import types as T

# The 20 canonical packet-table columns, in this order.
PACKET_COLUMNS = [
    "CLASS", "LEN_SRC_IP", "LEN_DEST_IP",
    "Source_IP1", "Source_IP2", "Source_IP3", "Source_IP4",
    "Destination_IP1", "Destination_IP2", "Destination_IP3", "Destination_IP4",
    "TCP_SPORT", "TCP_DPORT", "LEN_RAW",
    "Send_Year", "Send_Month", "Send_Day", "Send_Hour", "Send_Minute", "Send_Second",
]
LABEL_COLUMN = PACKET_COLUMNS[0]
FEATURE_COLUMNS = PACKET_COLUMNS[1:]

# The 13 application classes of the full data set.
ALL_CLASSES = [
    "Education", "Finance", "Games", "HealthFitness", "LifeService", "Music",
    "News", "Reading", "Shopping", "Social", "Tools", "Travel", "Video",
]
# The profiler's 9-class subset (no LifeService, Social, Tools, Video).
PROFILE_CLASSES = [
    "Education", "Finance", "Games", "HealthFitness", "Music", "News",
    "Reading", "Shopping", "Travel",
]

PACKET_SCHEMA = T.StructType(
    [T.StructField("CLASS", T.IntegerType(), False)]
    + [T.StructField(c, T.IntegerType(), True) for c in FEATURE_COLUMNS]
)

# Extended (optional) header fields, all nullable.
EXTENDED_INT_COLUMNS = (
    ["VERSION", "IHL"]
    + [f"DST_{i}" for i in range(1, 7)]
    + [f"SRC_{i}" for i in range(1, 7)]
    + ["TYPE", "LEN", "ID", "IP_FLAGS", "FRAG", "TTL", "PROTO", "CHKSUM",
       "DATAOFS", "RESERVED", "TCP_FLAGS", "WINDOW", "CHKSUM_", "URGPTR"]
)
EXTENDED_SCHEMA = T.StructType(
    list(PACKET_SCHEMA.fields)
    + [T.StructField(c, T.IntegerType(), True) for c in EXTENDED_INT_COLUMNS]
    + [
        T.StructField("SEQ", T.LongType(), True),
        T.StructField("ACK", T.LongType(), True),
        T.StructField("MESSAGE_RAW", T.BinaryType(), True),
        T.StructField("TIME_TCP", T.TimestampType(), True),
        T.StructField("NAME", T.StringType(), True),
    ]
)

# One row per captured record, as the capture source emits it.
FRAME_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("ordinal", T.LongType(), False),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("linktype", T.IntegerType(), False),
    T.StructField("orig_len", T.IntegerType(), False),
    T.StructField("frame", T.BinaryType(), False),
])

# Long metric samples: one row per (series, timestamp).
SAMPLE_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType()), False),
    T.StructField("value", T.DoubleType(), True),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("label", T.DoubleType(), False),
    T.StructField("prediction", T.DoubleType(), False),
])
