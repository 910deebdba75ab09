"""Stateless per-packet detectors (pure filters + projections; stream in append mode)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

c = F.col


def _mismatch(df: DataFrame, which: str, label: str) -> DataFrame:
    return df.filter(c(which) & c("has_mac_mismatch")).select(
        c("event_ts"),
        c("eth_src").alias("real_mac"),
        c("arp_src_mac").alias("claimed_mac"),
        c("arp_src_ip").alias("claimed_ip"),
        c("arp_dst_ip").alias("target_ip"),
        F.lit(label).alias("spoof_heuristic"),
    )


def detect_reply_mismatch(df: DataFrame, cfg=None) -> DataFrame:
    """a reply whose Ethernet source differs from its ARP sender MAC."""
    return _mismatch(df, "is_reply", "Reply MAC mismatch")


def detect_spoofed_requests(df: DataFrame, cfg=None) -> DataFrame:
    """The same check on requests (forged sender hardware address)."""
    return _mismatch(df, "is_request", "Request MAC mismatch")
