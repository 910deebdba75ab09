"""Raw ARP packets derived from the driver's ``events`` table by row expressions.

The test tables hold no capture, so each event becomes one packet (rules in
FIXTURES.md section 4): 64 packets per second from ``event_id``, a 10-second
attack burst in every 50 seconds from one MAC, replies for error/purchase events,
forged sender MACs, 0.0.0.0 probes and gratuitous announcements in several
spellings.  It is a pure projection, so it scales with ``events``.

What real captures also hold is there too: forged requests, storms of announcements inside the
bursts, silent stretches (90 s after every 4,000 packets), other and missing opcodes, missing
addresses, the all-zero MAC, and packets without a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lansight.schema import ZERO_MAC

# Fixed values of the packet adapter.
BASE_EPOCH = 1704067200
PACKETS_PER_SECOND = 64
BURST_PERIOD_PACKETS = 640
BURST_CYCLE = 5
MAC_PREFIX = "02:00:00:00:00:"
IP_PREFIX = "192.168.1."
ATTACKER_MAC = "02:00:00:00:00:66"
ATTACKER_IP = "192.168.1.66"
FORGED_MAC = "02:00:00:00:00:99"
GARP_SPELLINGS = ("True", " TRUE ", "1", "yes")
GAP_PACKETS, GAP_SECONDS = 4000, 90


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def _mac(n: str) -> str:
    return f"concat('{MAC_PREFIX}', lpad(CAST({n} AS STRING), 2, '0'))"


def _ip(n: str) -> str:
    return f"concat('{IP_PREFIX}', CAST({n} AS STRING))"


def _dirty(m: str) -> str:
    return f"CASE WHEN event_id % 7 = 0 THEN upper({m}) ELSE {m} END"


def packets_from_events(events: DataFrame, keep_id: bool = False) -> DataFrame:
    """events -> raw 9-column packet table (the capture schema); ``keep_id`` adds ``event_id``.

    Written as SQL expressions: they are parsed once on the JVM, which keeps
    plan construction cheap (no per-expression Python round trips)."""
    spell = ", ".join(f"'{x}'" for x in GARP_SPELLINGS)
    step1 = events.selectExpr(
        "event_id", "value", "event_type",
        "try_cast(regexp_extract(props, '[0-9]+', 0) AS INT) AS k",
        f"floor(event_id / {BURST_PERIOD_PACKETS}) % {BURST_CYCLE} = 1 AS burst",
        "user_id % 8 + 1 AS s",
    )
    step2 = step1.selectExpr(
        "event_id", "burst", "s",
        "CASE WHEN burst THEN k % 32 + 1 ELSE k % 10 + 1 END AS d",
        "event_type IN ('error', 'purchase') AND NOT (burst AND event_type = 'purchase') AS rep",
        "event_type = 'error' AND value >= 250 AS spoof",
        "event_type = 'signup' AND value >= 250 AS probe",
        "event_type = 'view' AND (value < 1 OR burst AND value < 40) AS garp",
        "event_type = 'click' AND value >= 150 AS forged",
    )
    eth_src = f"CASE WHEN burst THEN '{ATTACKER_MAC}' ELSE {_mac('s')} END"
    eth_dst = f"CASE WHEN rep THEN {_mac('d')} ELSE 'ff:ff:ff:ff:ff:ff' END"
    src_mac = f"CASE WHEN spoof OR forged THEN '{FORGED_MAC}' WHEN burst THEN '{ATTACKER_MAC}' ELSE {_mac('s')} END"
    src_ip = (f"CASE WHEN probe THEN '0.0.0.0' WHEN spoof THEN {_ip('s % 8 + 1')} "
              f"WHEN burst THEN '{ATTACKER_IP}' ELSE {_ip('s')} END")
    dst_mac = f"CASE WHEN rep THEN {_mac('d')} ELSE '00:00:00:00:00:00' END"
    time = (f"CAST({BASE_EPOCH} AS DOUBLE) + CAST(event_id AS DOUBLE) / {float(PACKETS_PER_SECOND)}D"
            f" + CAST(floor(event_id / {GAP_PACKETS}) * {GAP_SECONDS} AS DOUBLE)")
    return step2.selectExpr(
        *(["event_id"] if keep_id else []),
        f"CASE WHEN event_id % 997 <> 500 THEN {time} END AS `frame.time_epoch`",
        f"{_dirty(eth_src)} AS `eth.src`",
        f"{_dirty(eth_dst)} AS `eth.dst`",
        "CAST(CASE WHEN event_id % 211 = 5 THEN 3 WHEN event_id % 223 = 7 THEN NULL WHEN rep THEN 2 ELSE 1 END AS INT)"
        " AS `arp.opcode`",
        f"CASE WHEN event_id % 227 = 13 THEN '{ZERO_MAC}' WHEN event_id % 199 <> 11 THEN {_dirty(src_mac)} END"
        " AS `arp.src.hw_mac`",
        f"CASE WHEN event_id % 197 <> 3 THEN {src_ip} END AS `arp.src.proto_ipv4`",
        f"{_dirty(dst_mac)} AS `arp.dst.hw_mac`",
        f"{_ip('d')} AS `arp.dst.proto_ipv4`",
        f"CASE WHEN garp THEN element_at(array({spell}), CAST(event_id % 4 + 1 AS INT)) END AS `arp.isgratuitous`",
    )


EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(events_path(sf_dir)) \
        .select("event_id", "user_id", "event_type", "value", "props")


def raw_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_from_events(read_events(spark, sf_dir))
