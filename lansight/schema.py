"""Raw and enriched packet schemas."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# Capture field names in capture order, as exported by the
# packet dissector; the match with CSV files is by position.
RAW_FIELDS = (
    ("frame.time_epoch", DoubleType()),
    ("eth.src", StringType()),
    ("eth.dst", StringType()),
    ("arp.opcode", IntegerType()),
    ("arp.src.hw_mac", StringType()),
    ("arp.src.proto_ipv4", StringType()),
    ("arp.dst.hw_mac", StringType()),
    ("arp.dst.proto_ipv4", StringType()),
    ("arp.isgratuitous", StringType()),
)

RAW_SCHEMA = StructType([StructField(n, t, True) for n, t in RAW_FIELDS])
RAW_COLUMNS = tuple(n for n, _ in RAW_FIELDS)
CORRUPT_COLUMN = "_corrupt_record"
#: When a packet's file was written, or its record came in.
ARRIVAL = "_arrival"
RAW_SCHEMA_WITH_CORRUPT = StructType(RAW_SCHEMA.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])

ENRICHED_COLUMNS = (
    "event_ts",
    "epoch_ts",
    "eth_src",
    "eth_dst",
    "opcode",
    "arp_src_mac",
    "arp_src_ip",
    "arp_dst_mac",
    "arp_dst_ip",
    "is_gratuitous",
    "is_broadcast",
    "is_request",
    "is_reply",
    "has_mac_mismatch",
)

# Link-layer broadcast, unset MAC and unset IPv4 address.
BROADCAST_MAC = "ff:ff:ff:ff:ff:ff"
ZERO_MAC = "00:00:00:00:00:00"
UNSET_IP = "0.0.0.0"
# Spellings accepted as "gratuitous = true".
TRUE_SPELLINGS = ("true", "1", "yes", "t", "y")
