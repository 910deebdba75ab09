"""Reports over the nine detection tables: one tall alert table, per-detector
counts, status and the weighted threat score — all from a single aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lansight.config import DEFAULT, ArpConfig

c = F.col

# Detector keys in report order with their threat-weight names.
DETECTORS = (
    ("scanning", "scanning"),
    ("garp", "garp"),
    ("spoof_reply_mismatch", "reply_mismatch"),
    ("spoof_mac_flipping", "mac_flipping"),
    ("spoof_ip_flipping", "ip_flipping"),
    ("flood", "flood"),
    ("unsolicited", "unsolicited"),
    ("impersonation", "impersonation"),
    ("conflict", "conflict"),
)
SPOOF_DETECTORS = ("spoof_reply_mismatch", "spoof_mac_flipping", "spoof_ip_flipping")
ALERT_COLUMNS = ("detector", "ts", "entity", "metric", "detail")


def _s(col: str) -> Column:
    return c(col).cast("string")


def _detail(*parts) -> Column:
    """'a=1 b=2' text; a null value reads ``null``, so the other parts stay."""
    pieces = []
    for i, (label, col) in enumerate(parts):
        pieces += [F.lit(("" if i == 0 else " ") + label + "="), F.coalesce(_s(col), F.lit("null"))]
    return F.concat(*pieces)


# detector -> (time column, entity column, metric column, detail parts)
_PROJECTIONS = {
    "scanning": ("window_start", "scanner_mac", "unique_targets", (("requests", "total_requests"),)),
    "garp": ("window_start", "mac", "garp_count", (("claimed_ips", "claimed_ip_count"),)),
    "spoof_reply_mismatch": ("event_ts", "real_mac", None, (("claimed_mac", "claimed_mac"), ("claimed_ip", "claimed_ip"))),
    "spoof_mac_flipping": ("window_start", "eth_mac", "unique_arp_macs", (("arp_ips", "unique_arp_ips"),)),
    "spoof_ip_flipping": ("window_start", "mac", "unique_src_ips", (("packets", "packet_count"),)),
    "flood": ("second", "mac", "requests_per_sec", (("unique_targets", "unique_targets"),)),
    "unsolicited": ("time", "mac", None, (("ip", "ip"), ("advertised_mac", "advertised_mac"))),
    "impersonation": ("window_start", "mac", "unique_src_ips",
                      (("arp_macs", "unique_arp_macs"), ("identities", "identity_count"))),
    "conflict": ("window_start", "contested_ip", "claiming_mac_count", (("claims", "claim_count"),)),
}


def alert_projection(name: str, df: DataFrame) -> DataFrame:
    ts, entity, metric, detail = _PROJECTIONS[name]
    return df.select(
        F.lit(name).alias("detector"),
        c(ts).alias("ts"),
        c(entity).alias("entity"),
        (c(metric).cast("bigint") if metric else F.lit(1).cast("bigint")).alias("metric"),
        _detail(*detail).alias("detail"),
    )


def alerts_unified(detections: dict[str, DataFrame]) -> DataFrame:
    """Every detection as (detector, ts, entity, metric, detail)."""
    parts = [alert_projection(name, detections[name]) for name, _ in DETECTORS if name in detections]
    # balanced union tree: each union step re-checks only its two subtrees
    while len(parts) > 1:
        parts = [parts[i].union(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _counts_row(alerts: DataFrame) -> DataFrame:
    return alerts.agg(*[F.count_if(c("detector") == name).alias(name) for name, _ in DETECTORS])


def counts_of(detections: dict[str, DataFrame], names=tuple(n for n, _ in DETECTORS)) -> DataFrame:
    """One row with the number of rows of each named detection, straight from the
    detections: no alert text is built, and other detectors are not planned."""
    parts = [detections[n].agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("detector"), "n") for n in names]
    table = reduce(DataFrame.union, parts)
    return table.agg(*[F.sum(F.when(c("detector") == n, c("n"))).alias(n) for n in names])


def summary_of(counts: DataFrame) -> DataFrame:
    """Rows per detector, zero rows included (one row of counts, unpivoted)."""
    stack = ", ".join(f"'{name}', `{name}`" for name in counts.columns)
    return counts.selectExpr(f"stack({len(counts.columns)}, {stack}) AS (detector, detections)")


def status_of(counts: DataFrame) -> DataFrame:
    """R2: ALERT when a detector fired, else Clean."""
    return summary_of(counts).withColumn("status", F.when(c("detections") > 0, "ALERT").otherwise("Clean"))


def detection_summary(alerts: DataFrame) -> DataFrame:
    """R1 from a written alert table."""
    return summary_of(_counts_row(alerts))


def detection_status(alerts: DataFrame) -> DataFrame:
    """R2 from a written alert table."""
    return status_of(_counts_row(alerts))


def threat_level(score: Column) -> Column:
    """< 25 LOW, < 60 ELEVATED, else CRITICAL."""
    return F.when(score < 25, "LOW").when(score < 60, "ELEVATED").otherwise("CRITICAL")


def threat_score(alerts: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """R3/R4 from a written alert table."""
    return score_of(_counts_row(alerts), cfg)


def score_of(counts: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """Sum of the weights of detectors with at least one row, capped."""
    raw = reduce(lambda a, b: a + b, [
        F.when(c(name) > 0, F.lit(int(cfg.threat_weights[w]))).otherwise(F.lit(0)) for name, w in DETECTORS])
    firing = reduce(lambda a, b: a + b, [F.when(c(name) > 0, 1).otherwise(0) for name, _ in DETECTORS])
    score = F.least(raw, F.lit(cfg.threat_cap)).cast("int")
    return counts.select(score.alias("threat_score"), threat_level(score).alias("threat_level"),
                         firing.cast("int").alias("detectors_firing"))


def spoofing_summary(detections: dict[str, DataFrame]) -> DataFrame:
    """The three spoofing heuristics' counts, from their detections alone."""
    return summary_of(counts_of(detections, SPOOF_DETECTORS))


def alerts_json(alerts: DataFrame) -> DataFrame:
    """Kafka-ready (key, value) records of the alert table."""
    return alerts.select(c("detector").alias("key"), F.to_json(F.struct(*ALERT_COLUMNS)).alias("value"))


def chart_frames(detections: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The column subsets the dashboard plots (scan scatter, flood line,
    GARP bars, conflict bars) — projections only, nothing collected."""
    return {
        "scan_scatter": detections["scanning"].select("window_start", "window_end", "scanner_mac", "unique_targets",
                                                    "total_requests", "targeted_ip_count"),
        "flood_line": detections["flood"].select("second", "mac", "requests_per_sec"),
        "garp_bars": detections["garp"].select("mac", "garp_count", "claimed_ip_count"),
        "conflict_bars": detections["conflict"].select("contested_ip", "claiming_mac_count", "claim_count"),
    }
