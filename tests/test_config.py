from __future__ import annotations

import subprocess
import sys

from conftest import BASE, pkt

from lansight.config import DEFAULT, ArpConfig
from lansight.operators import rules
from lansight.plans import batch


def test_thresholds_and_weights_are_parameters(packets):
    rows = [pkt(BASE + i / 100, dst_ip=f"10.0.0.{i}") for i in range(20)]
    p = packets(rows)
    assert rules.detect_flood(p).count() == 0
    assert rules.detect_flood(p, DEFAULT.with_(flood_requests=20)).count() == 1
    cfg = ArpConfig(threat_weights={**DEFAULT.threat_weights, "scanning": 70, "flood": 0})
    t = batch.run_batch(p, cfg).threat(cfg).first()
    assert (t.threat_score, t.threat_level) == (70, "CRITICAL")


def test_impersonation_exclusion_option(packets):
    rows = [pkt(BASE + 1, src_ip="0.0.0.0"), pkt(BASE + 2, src_ip="10.0.0.7")]
    p = packets(rows)
    assert rules.detect_impersonation(p).count() == 1
    assert rules.detect_impersonation(p, DEFAULT.with_(impersonation_exclude_unset=True)).count() == 0


def test_job_cli_help():
    out = subprocess.run([sys.executable, "lansight/job.py", "--help"], capture_output=True, text=True,
                         cwd=__file__.rsplit("/tests/", 1)[0], timeout=120)
    assert out.returncode == 0 and "--mode" in out.stdout
