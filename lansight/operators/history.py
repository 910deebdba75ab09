"""IP -> MAC history: remaps (D2) and flapping (D3).

"Last known MAC of an IP" is a sequential question.  To keep one busy IP from
landing in a single task, the packets of an IP are cut into time buckets: the
previous MAC is taken inside each (ip, bucket) partition with ``lag``, and the
first packet of a bucket gets the last MAC of the IP's previous non-empty bucket
from a small per-(ip, bucket) summary (``max_by`` + ``lag`` over buckets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lansight.config import DEFAULT, ArpConfig
from lansight.schema import UNSET_IP, ZERO_MAC

c = F.col


def claims(df: DataFrame) -> DataFrame:
    """Replies and GARPs that bind a real IP to a real MAC."""
    return df.filter((c("is_reply") | c("is_gratuitous")) & c("arp_src_ip").isNotNull()
                     & (c("arp_src_ip") != UNSET_IP) & c("arp_src_mac").isNotNull()
                     & (c("arp_src_mac") != ZERO_MAC) & c("epoch_ts").isNotNull() & c("event_ts").isNotNull())


def ip_mac_remap(df: DataFrame, cfg: ArpConfig = DEFAULT, bucket_seconds: int = 10) -> DataFrame:
    """Claims whose MAC differs from the previous claim for the same IP.

    Order within an IP is (epoch_ts, arp_src_mac, eth_src).  One window pass over
    (ip, bucket) gives each claim's previous MAC inside its bucket and the
    bucket's last MAC; the first claim of a bucket takes the last MAC of the
    IP's previous non-empty bucket (a ``lag`` over one row per bucket).  Buckets
    are short, so a busy address is spread over many of them, and only one row
    per bucket follows an address through the capture."""
    ev = claims(df).select("event_ts", "epoch_ts", "eth_src", c("arp_src_ip").alias("ip"),
                           c("arp_src_mac").alias("mac"),
                           F.floor(c("epoch_ts") / F.lit(float(bucket_seconds))).alias("bucket"))
    in_bucket = Window.partitionBy("ip", "bucket").orderBy("epoch_ts", "mac", F.asc_nulls_first("eth_src"))
    whole_bucket = in_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a bucket's first claim is the one without a predecessor (claims always have an
    # epoch); testing that instead of row_number() = 1 keeps both branches below on
    # the same plan, so the packets are scanned and shuffled once
    ev = ev.select("*", F.lag("mac").over(in_bucket).alias("prev_mac"),
                   F.lag("epoch_ts").over(in_bucket).alias("prev_epoch"),
                   F.last("mac").over(whole_bucket).alias("bucket_last"))
    firsts = ev.filter(c("prev_epoch").isNull()).withColumn(
        "prev_mac", F.lag("bucket_last").over(Window.partitionBy("ip").orderBy("bucket")))
    both = ev.filter(c("prev_epoch").isNotNull()).unionByName(firsts)
    return both.filter(c("prev_mac").isNotNull() & (c("prev_mac") != c("mac"))).select(
        "event_ts", "ip", c("prev_mac").alias("previous_mac"), c("mac").alias("new_mac"), "eth_src",
        F.lit("IP-MAC remap").alias("heuristic"))


def mac_flap(df: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """D3: IPs whose MAC changes more than ``mac_flap_changes`` times in a window."""
    remaps = ip_mac_remap(df, cfg)
    per_mac = remaps.groupBy(F.window("event_ts", f"{cfg.mac_flap_window} seconds").alias("window"), "ip",
                             "new_mac").agg(F.count(F.lit(1)).alias("n"))
    return (per_mac.groupBy("window", "ip").agg(F.sum("n").cast("bigint").alias("mac_changes"),
                                                F.count(F.lit(1)).cast("bigint").alias("distinct_new_macs"))
            .filter(c("mac_changes") > cfg.mac_flap_changes)
            .select(c("window.start").alias("window_start"), c("window.end").alias("window_end"), "ip",
                    "mac_changes", "distinct_new_macs"))
