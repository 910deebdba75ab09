"""Batch plan: one packet table in, the nine detection tables, the alert table
and the profile out — all lazy DataFrames.

The three 30-second identity rules are compiled as one family so they share a
single pre-aggregate; Spark reuses identical exchanges when several outputs are
computed in one plan (e.g. the alert table)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from lansight.config import DEFAULT, ArpConfig
from lansight.operators import events, joins, rules, traffic
from lansight.operators.windows import compile_batch_all
from lansight.plans import onepass, report


def detections(packets: DataFrame, cfg: ArpConfig = DEFAULT) -> dict[str, DataFrame]:
    out = compile_batch_all(packets, rules.standard_rules(cfg))
    out["spoof_reply_mismatch"] = events.detect_reply_mismatch(packets)
    out["unsolicited"] = joins.detect_unsolicited(packets, cfg)
    return {name: out[name] for name, _ in report.DETECTORS}


@dataclass
class BatchResult:
    packets: DataFrame
    detections: dict[str, DataFrame]
    alerts: DataFrame
    cfg: ArpConfig = DEFAULT

    def summary(self) -> DataFrame:
        return report.status_of(onepass.counts(self.packets, self.cfg))

    def threat(self, cfg: ArpConfig | None = None) -> DataFrame:
        return report.score_of(onepass.counts(self.packets, self.cfg), cfg or self.cfg)

    def profile(self) -> dict[str, DataFrame]:
        return traffic.profile(self.packets)


def run_batch(packets: DataFrame, cfg: ArpConfig = DEFAULT, persist: bool = False) -> BatchResult:
    """``persist`` keeps the packet table for several actions on a small input;
    on large inputs read a Parquet archive instead, so each rule scans only its
    columns."""
    if persist:
        packets = packets.persist(StorageLevel.MEMORY_AND_DISK)
    det = detections(packets, cfg)
    return BatchResult(packets, det, onepass.alerts(packets, cfg), cfg)
