"""The window rules of the detector library, declared as ``WindowRule`` specs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lansight.config import DEFAULT, ArpConfig
from lansight.operators.windows import (
    Count,
    Distinct,
    First,
    Last,
    Pairs,
    SetSize,
    WindowRule,
    compile_batch,
    compile_batch_family,
)
from lansight.schema import UNSET_IP, ZERO_MAC

c = F.col


def _ws():
    return c("window.start")


def _we():
    return c("window.end")


def _valid_src_ip():
    return c("arp_src_ip").isNotNull() & (c("arp_src_ip") != UNSET_IP)


def scanning_rule(cfg: ArpConfig = DEFAULT) -> WindowRule:
    """A1: broadcast requests to many distinct targets in a sliding window."""
    return WindowRule(
        name="scanning",
        where=lambda: c("is_request") & c("is_broadcast"),
        key="eth_src",
        size=cfg.scan_window,
        slide=cfg.scan_slide,
        measures=(
            Distinct("arp_dst_ip", "unique_targets"),
            Count("total_requests"),
            SetSize("arp_dst_ip", "targeted_ip_count"),
            First("window_first_ts"),
            Last("window_last_ts"),
        ),
        having=lambda: c("unique_targets") >= cfg.scan_unique_targets,
        output=(
            ("window_start", _ws),
            ("window_end", _we),
            ("scanner_mac", lambda: c("eth_src")),
            ("unique_targets", lambda: c("unique_targets")),
            ("total_requests", lambda: c("total_requests")),
            ("targeted_ip_count", lambda: c("targeted_ip_count")),
            ("window_first_ts", lambda: c("window_first_ts")),
            ("window_last_ts", lambda: c("window_last_ts")),
        ),
    )


def garp_rule(cfg: ArpConfig = DEFAULT, *, name: str = "garp", window: int | None = None,
              threshold: int | None = None) -> WindowRule:
    """A2: gratuitous announcements per sender MAC (D4 'garp storm' is the same rule, other knobs)."""
    thr = cfg.garp_count if threshold is None else threshold
    return WindowRule(
        name=name,
        where=lambda: c("is_gratuitous") == F.lit(True),
        key="eth_src",
        size=cfg.garp_window if window is None else window,
        measures=(
            Count("garp_count"),
            SetSize("arp_src_ip", "claimed_ip_count"),
            First("first_garp"),
            Last("last_garp"),
        ),
        having=lambda: c("garp_count") >= thr,
        output=(
            ("window_start", _ws),
            ("window_end", _we),
            ("mac", lambda: c("eth_src")),
            ("garp_count", lambda: c("garp_count")),
            ("claimed_ip_count", lambda: c("claimed_ip_count")),
            ("first_garp", lambda: c("first_garp")),
            ("last_garp", lambda: c("last_garp")),
        ),
    )


def mac_flipping_rule(cfg: ArpConfig = DEFAULT) -> WindowRule:
    """A3: one Ethernet source announcing several ARP sender MACs."""
    return WindowRule(
        name="spoof_mac_flipping",
        where=lambda: (c("is_reply") | c("is_gratuitous")) & c("arp_src_mac").isNotNull()
        & (c("arp_src_mac") != ZERO_MAC),
        key="eth_src",
        size=cfg.impersonation_window,
        measures=(
            Distinct("arp_src_mac", "unique_arp_macs"),
            Distinct("arp_src_ip", "unique_arp_ips"),
            Pairs(("arp_src_mac", "arp_src_ip"), "identity_count"),
            Count("packet_count"),
        ),
        having=lambda: c("unique_arp_macs") > 1,
        output=(
            ("window_start", _ws),
            ("window_end", _we),
            ("eth_mac", lambda: c("eth_src")),
            ("unique_arp_macs", lambda: c("unique_arp_macs")),
            ("unique_arp_ips", lambda: c("unique_arp_ips")),
            ("identity_count", lambda: c("identity_count")),
            ("packet_count", lambda: c("packet_count")),
            ("spoof_heuristic", lambda: F.lit("MAC flipping")),
        ),
    )


def ip_flipping_rule(cfg: ArpConfig = DEFAULT) -> WindowRule:
    """A4: one Ethernet source claiming several sender IPs."""
    return WindowRule(
        name="spoof_ip_flipping",
        where=lambda: (c("is_reply") | c("is_gratuitous") | c("is_request")) & _valid_src_ip(),
        key="eth_src",
        size=cfg.impersonation_window,
        measures=(
            Distinct("arp_src_ip", "unique_src_ips"),
            SetSize("arp_src_ip", "ip_count"),
            Count("packet_count"),
        ),
        having=lambda: c("unique_src_ips") >= cfg.impersonation_ip_count,
        output=(
            ("window_start", _ws),
            ("window_end", _we),
            ("mac", lambda: c("eth_src")),
            ("unique_src_ips", lambda: c("unique_src_ips")),
            ("ip_count", lambda: c("ip_count")),
            ("packet_count", lambda: c("packet_count")),
            ("spoof_heuristic", lambda: F.lit("IP flipping")),
        ),
    )


def flood_rule(cfg: ArpConfig = DEFAULT) -> WindowRule:
    """A5: requests per sender per flood window (a raw count, not divided by the length)."""
    return WindowRule(
        name="flood",
        where=lambda: c("is_request"),
        key="eth_src",
        size=cfg.flood_window,
        measures=(
            Count("requests_per_sec"),
            Distinct("arp_dst_ip", "unique_targets"),
            First("second_start"),
            Last("second_end"),
        ),
        having=lambda: c("requests_per_sec") >= cfg.flood_requests,
        output=(
            ("second", _ws),
            ("mac", lambda: c("eth_src")),
            ("requests_per_sec", lambda: c("requests_per_sec")),
            ("unique_targets", lambda: c("unique_targets")),
            ("second_start", lambda: c("second_start")),
            ("second_end", lambda: c("second_end")),
        ),
    )


def impersonation_rule(cfg: ArpConfig = DEFAULT) -> WindowRule:
    """A MAC using several IPs or several ARP sender MACs (0.0.0.0 probes included)."""
    if cfg.impersonation_exclude_unset:
        where = lambda: (c("is_request") | c("is_reply")) & _valid_src_ip() & (
            c("arp_src_mac").isNull() | (c("arp_src_mac") != ZERO_MAC))
    else:
        where = lambda: c("is_request") | c("is_reply")
    return WindowRule(
        name="impersonation",
        where=where,
        key="eth_src",
        size=cfg.impersonation_window,
        measures=(
            Distinct("arp_src_ip", "unique_src_ips"),
            Distinct("arp_src_mac", "unique_arp_macs"),
            Pairs(("arp_src_ip", "arp_src_mac"), "identity_count"),
            Count("total_packets"),
        ),
        having=lambda: (c("unique_src_ips") >= cfg.impersonation_ip_count) | (c("unique_arp_macs") > 1),
        output=(
            ("window_start", _ws),
            ("window_end", _we),
            ("mac", lambda: c("eth_src")),
            ("unique_src_ips", lambda: c("unique_src_ips")),
            ("unique_arp_macs", lambda: c("unique_arp_macs")),
            ("identity_count", lambda: c("identity_count")),
            ("total_packets", lambda: c("total_packets")),
            ("alert_type", lambda: F.lit("MAC impersonation")),
        ),
    )


def conflict_rule(cfg: ArpConfig = DEFAULT) -> WindowRule:
    """One IP claimed by several MACs (replies and GARPs)."""
    return WindowRule(
        name="conflict",
        where=lambda: (c("is_reply") | c("is_gratuitous")) & _valid_src_ip(),
        key="arp_src_ip",
        size=cfg.conflict_window,
        measures=(
            Distinct("arp_src_mac", "claiming_mac_count"),
            SetSize("arp_src_mac", "mac_count"),
            Count("claim_count"),
        ),
        having=lambda: c("claiming_mac_count") > 1,
        output=(
            ("window_start", _ws),
            ("window_end", _we),
            ("contested_ip", lambda: c("arp_src_ip")),
            ("claiming_mac_count", lambda: c("claiming_mac_count")),
            ("mac_count", lambda: c("mac_count")),
            ("claim_count", lambda: c("claim_count")),
            ("conflict_type", lambda: F.lit("IP conflict")),
        ),
    )


def standard_rules(cfg: ArpConfig = DEFAULT) -> list[WindowRule]:
    return [
        scanning_rule(cfg),
        garp_rule(cfg),
        flood_rule(cfg),
        impersonation_rule(cfg),
        conflict_rule(cfg),
        mac_flipping_rule(cfg),
        ip_flipping_rule(cfg),
    ]


# ---------------------------------------------------------------------------
# operator-style entry points (df, config) -> DataFrame
# ---------------------------------------------------------------------------

def detect_scanning(df: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    return compile_batch(df, scanning_rule(cfg))


def detect_garp(df: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    return compile_batch(df, garp_rule(cfg))


def detect_flood(df: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    return compile_batch(df, flood_rule(cfg))


def detect_impersonation(df: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    return compile_batch(df, impersonation_rule(cfg))


def detect_conflicts(df: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    return compile_batch(df, conflict_rule(cfg))


def detect_mac_flipping(df: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    return compile_batch(df, mac_flipping_rule(cfg))


def detect_ip_flipping(df: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    return compile_batch(df, ip_flipping_rule(cfg))


def identity_rules(cfg: ArpConfig = DEFAULT) -> list[WindowRule]:
    """Same window and key, one family."""
    return [mac_flipping_rule(cfg), ip_flipping_rule(cfg), impersonation_rule(cfg)]


def detect_identity_family(df: DataFrame, cfg: ArpConfig = DEFAULT) -> dict[str, DataFrame]:
    """A3, A4 and A6 over one shared level-1 aggregate (one shuffle of the packets)."""
    return compile_batch_family(df, identity_rules(cfg))


def detect_garp_storm(df: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """GARP rate per MAC above a threshold in a short window."""
    rule = garp_rule(cfg, name="garp_storm", window=cfg.garp_storm_window,
                     threshold=cfg.garp_storm_threshold + 1)
    return compile_batch(df, rule)


# ---------------------------------------------------------------------------
# the aggregate primitives, each alone and with no threshold
# ---------------------------------------------------------------------------

def window_tumbling_counts(df: DataFrame, size: int = 10) -> DataFrame:
    rule = WindowRule(
        name="window_tumbling_counts", where=lambda: F.lit(True), key="eth_src", size=size,
        measures=(Count("packets"),), having=lambda: F.lit(True),
        output=(("window_start", _ws), ("window_end", _we), ("eth_src", lambda: c("eth_src")),
                ("packets", lambda: c("packets"))))
    return compile_batch(df.filter(c("event_ts").isNotNull()), rule)


def window_sliding_counts(df: DataFrame, size: int = 10, slide: int = 5) -> DataFrame:
    rule = WindowRule(
        name="window_sliding_counts", where=lambda: F.lit(True), key="eth_src", size=size, slide=slide,
        measures=(Count("packets"),), having=lambda: F.lit(True),
        output=(("window_start", _ws), ("window_end", _we), ("eth_src", lambda: c("eth_src")),
                ("packets", lambda: c("packets"))))
    return compile_batch(df, rule)


def window_distinct_targets(df: DataFrame, size: int = 10) -> DataFrame:
    rule = WindowRule(
        name="window_distinct_targets", where=lambda: c("is_request"), key="eth_src", size=size,
        measures=(Distinct("arp_dst_ip", "distinct_targets"), Count("requests")), having=lambda: F.lit(True),
        output=(("window_start", _ws), ("eth_src", lambda: c("eth_src")),
                ("distinct_targets", lambda: c("distinct_targets")), ("requests", lambda: c("requests"))))
    return compile_batch(df, rule)


def window_identity_pairs(df: DataFrame, size: int = 30) -> DataFrame:
    rule = WindowRule(
        name="window_identity_pairs", where=lambda: F.lit(True), key="eth_src", size=size,
        measures=(Pairs(("arp_src_ip", "arp_src_mac"), "identity_count"),), having=lambda: F.lit(True),
        output=(("window_start", _ws), ("eth_src", lambda: c("eth_src")),
                ("identity_count", lambda: c("identity_count"))))
    return compile_batch(df, rule)


def window_first_last(df: DataFrame, size: int = 10) -> DataFrame:
    rule = WindowRule(
        name="window_first_last", where=lambda: F.lit(True), key="eth_src", size=size,
        measures=(First("first_ts"), Last("last_ts")), having=lambda: F.lit(True),
        output=(("window_start", _ws), ("eth_src", lambda: c("eth_src")),
                ("first_ts", lambda: c("first_ts")), ("last_ts", lambda: c("last_ts"))))
    return compile_batch(df, rule)
