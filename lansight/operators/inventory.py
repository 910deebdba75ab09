"""MAC <-> IP inventories (two-level aggregates, no per-key sets)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lansight.schema import UNSET_IP, ZERO_MAC

c = F.col


def _bindings(df: DataFrame) -> DataFrame:
    return (df.filter(c("arp_src_mac").isNotNull() & (c("arp_src_mac") != ZERO_MAC) & c("arp_src_ip").isNotNull()
                      & (c("arp_src_ip") != UNSET_IP))
            .groupBy("arp_src_mac", "arp_src_ip")
            .agg(F.count(F.lit(1)).alias("n"), F.min("event_ts").alias("f"), F.max("event_ts").alias("l")))


def _inventory(df: DataFrame, key: str, other: str, count_name: str) -> DataFrame:
    return _bindings(df).groupBy(key).agg(
        F.count(other).alias(count_name),
        F.sum("n").cast("bigint").alias("packets"),
        F.min("f").alias("first_seen"),
        F.max("l").alias("last_seen"),
    )


def mac_inventory(df: DataFrame) -> DataFrame:
    """Per ARP sender MAC: how many IPs it claimed, packets, first and last sighting."""
    return _inventory(df, "arp_src_mac", "arp_src_ip", "ip_count").withColumnRenamed("arp_src_mac", "mac")


def ip_inventory(df: DataFrame) -> DataFrame:
    """Per sender IP: how many MACs claimed it, packets, first and last sighting."""
    return _inventory(df, "arp_src_ip", "arp_src_mac", "mac_count").withColumnRenamed("arp_src_ip", "ip")
