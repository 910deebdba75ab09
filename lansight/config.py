"""Detector configuration: one frozen value object handed to every operator."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from types import MappingProxyType
from typing import Mapping


# Fixed values that must equal the reference for identical detections:
# window lengths and slides (seconds), thresholds, streaming knobs and the
# threat weights per detector.
DEFAULT_THREAT_WEIGHTS: Mapping[str, int] = MappingProxyType({
    "scanning": 12,
    "flood": 25,
    "reply_mismatch": 18,
    "mac_flipping": 20,
    "ip_flipping": 12,
    "unsolicited": 14,
    "impersonation": 100,
    "conflict": 10,
    "garp": 4,
})


@dataclass(frozen=True)
class ArpConfig:
    # windows (seconds)
    scan_window: int = 10
    scan_slide: int = 5
    flood_window: int = 1
    garp_window: int = 60
    impersonation_window: int = 30
    conflict_window: int = 10
    unsolicited_lookback: int = 5

    # thresholds
    scan_unique_targets: int = 15
    flood_requests: int = 50
    garp_count: int = 1
    impersonation_ip_count: int = 2

    # streaming
    max_files_per_trigger: int = 1
    watermark_seconds: int = 15
    # packets dated later than their arrival by more than this are set aside on streams
    clock_ahead_seconds: int = 86_400
    stream_retries: int = 3

    # sources
    kafka_bootstrap_servers: str = "localhost:9092"
    kafka_topic: str = "network-arp-raw"

    # threat score
    threat_weights: Mapping[str, int] = field(default_factory=lambda: DEFAULT_THREAT_WEIGHTS)
    threat_cap: int = 100

    # Options the reference does not have (all off by default so results match it).
    # "seconds": event time truncated to whole seconds like the reference;
    # "micros": keep the sub-second fraction.
    time_precision: str = "seconds"
    # A6 counts 0.0.0.0 probes and the zero MAC as identities; True drops them.
    impersonation_exclude_unset: bool = False

    # Documented-but-uncoded rules.
    garp_storm_window: int = 10
    garp_storm_threshold: int = 5
    unsolicited_mac_lookback: int = 2
    mac_flap_window: int = 60
    mac_flap_changes: int = 1
    feature_window: int = 10
    outlier_k: int = 2
    outlier_seed: int = 1

    def with_(self, **changes) -> "ArpConfig":
        return replace(self, **changes)


DEFAULT = ArpConfig()
