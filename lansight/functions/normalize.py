"""Packet normalisation: raw dotted capture columns -> one clean packet table.

Everything is a single ``select`` of built-in expressions, so Catalyst can push
later rule predicates (``opcode = 1`` ...) through it into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lansight.config import DEFAULT, ArpConfig
from lansight.functions.timefn import event_ts_sql
from lansight.schema import BROADCAST_MAC, TRUE_SPELLINGS, ZERO_MAC


def raw(name: str) -> Column:
    """Column of the raw table; dotted names need back quotes."""
    return F.col(f"`{name}`")


def mac_canonical(c: Column) -> Column:
    return F.lower(F.trim(c))


def gratuitous_flag(c: Column) -> Column:
    """Multi-spelling boolean parse; null stays null."""
    return F.lower(F.trim(c)).isin(*TRUE_SPELLINGS)


def opcode_label(opcode: Column) -> Column:
    return F.when(opcode == 1, "Request").when(opcode == 2, "Reply").otherwise("Other")


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def enrich_exprs(precision: str = "seconds") -> list[str]:
    """The normalisation as SQL expressions over the raw dotted columns."""
    event_ts = event_ts_sql("`frame.time_epoch`", precision)
    eth_src, eth_dst = "lower(trim(`eth.src`))", "lower(trim(`eth.dst`))"
    opcode, src_mac = "try_cast(`arp.opcode` AS INT)", "lower(trim(`arp.src.hw_mac`))"
    return [
        f"{event_ts} AS event_ts",
        "try_cast(`frame.time_epoch` AS DOUBLE) AS epoch_ts",
        f"{eth_src} AS eth_src",
        f"{eth_dst} AS eth_dst",
        f"{opcode} AS opcode",
        f"{src_mac} AS arp_src_mac",
        "trim(`arp.src.proto_ipv4`) AS arp_src_ip",
        "lower(trim(`arp.dst.hw_mac`)) AS arp_dst_mac",
        "trim(`arp.dst.proto_ipv4`) AS arp_dst_ip",
        f"lower(trim(`arp.isgratuitous`)) IN ({_sql_list(TRUE_SPELLINGS)}) AS is_gratuitous",
        f"{eth_dst} = '{BROADCAST_MAC}' AS is_broadcast",
        f"{opcode} = 1 AS is_request",
        f"{opcode} = 2 AS is_reply",
        f"{eth_src} <> {src_mac} AND {src_mac} IS NOT NULL AND {src_mac} <> '{ZERO_MAC}' AS has_mac_mismatch",
    ]


def enrich(raw_df: DataFrame, config: ArpConfig = DEFAULT, watermark: bool = False) -> DataFrame:
    """Raw packets (9 dotted columns) -> enriched packets (14 columns).

    One projection (parsed once on the JVM); ``watermark`` adds the event-time
    watermark, which only matters for streams feeding a stateful operator.
    """
    out = raw_df.selectExpr(*enrich_exprs(config.time_precision))
    if watermark:
        out = out.withWatermark("event_ts", f"{config.watermark_seconds} seconds")
    return out
