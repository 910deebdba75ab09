"""Traffic profile (T1-T5, D8, D12), history (D2, D3), inventories and reports."""

from __future__ import annotations

import random

import brute
from conftest import BASE, pkt

from lansight.operators import history, inventory, traffic
from lansight.plans import batch, report


def test_timeline_fills_gaps_with_zero(packets):
    rows = [pkt(BASE), pkt(BASE, opcode=2), pkt(BASE + 3, garp="True", opcode=None), pkt(None)]
    out = [tuple(r) for r in traffic.traffic_timeline(packets(rows)).orderBy("second").collect()]
    assert out == [("2026-05-05 20:44:00", 1, 1, 0), ("2026-05-05 20:44:01", 0, 0, 0),
                   ("2026-05-05 20:44:02", 0, 0, 0), ("2026-05-05 20:44:03", 0, 0, 1)]


def test_timeline_spans_hours(packets):
    rows = [pkt(BASE), pkt(BASE + 3 * 3600 + 7)]
    df = traffic.traffic_timeline(packets(rows))
    assert df.count() == 3 * 3600 + 8
    r = traffic.packet_rate(packets(rows)).first()
    assert (r.span_seconds, r.packets, r.peak_pps, r.idle_seconds) == (3 * 3600 + 8, 2, 1, 3 * 3600 + 6)


def test_top_talkers_tie_break_and_limit(packets):
    rows = []
    for i in range(12):
        rows += [pkt(BASE, eth_src=f"02:00:00:00:00:{i:02d}", dst_ip=f"10.0.0.{j}") for j in range(1 + (i % 3))]
    out = [tuple(r) for r in traffic.top_talkers(packets(rows)).collect()]
    assert len(out) == 10
    assert out[:4] == [("02:00:00:00:00:02", 3, 3), ("02:00:00:00:00:05", 3, 3), ("02:00:00:00:00:08", 3, 3),
                       ("02:00:00:00:00:11", 3, 3)]


def test_opcode_groups_include_null(packets):
    rows = [pkt(BASE, opcode=1), pkt(BASE, opcode=2), pkt(BASE, opcode=None), pkt(BASE, opcode=9)]
    got = sorted((tuple(r) for r in traffic.opcode_distribution(packets(rows)).collect()), key=repr)
    assert got == sorted([(1, 1, "Request"), (2, 1, "Reply"), (None, 1, "Other"), (9, 1, "Other")], key=repr)
    t = traffic.packet_totals(packets(rows + [pkt(BASE, garp="yes")])).first()
    assert tuple(t) == (5, 2, 1, 1)


def test_remap_matches_brute_force_across_buckets(packets):
    rng = random.Random(5)
    rows = [pkt(BASE + rng.random() * 20000, opcode=rng.choice([2, 2, 1]), garp=rng.choice([None, None, "True"]),
                eth_src=rng.choice(["02:00:00:00:00:01", "02:00:00:00:00:02"]),
                src_mac=rng.choice(["02:00:00:00:00:0a", "02:00:00:00:00:0b", "00:00:00:00:00:00"]),
                src_ip=rng.choice(["10.0.0.1", "10.0.0.2", "0.0.0.0"])) for _ in range(600)]
    p = packets(rows)
    want = brute.remaps(brute.norm(rows))
    # small buckets force many bucket edges
    got = sorted((int(r.event_ts.timestamp()), r.ip, r.previous_mac, r.new_mac)
                 for r in history.ip_mac_remap(p, bucket_seconds=60).collect())
    assert got == want and len(want) > 20
    assert history.mac_flap(p).count() >= 0


def test_inventories(packets):
    rows = [pkt(BASE, src_mac="02:00:00:00:00:0a", src_ip="10.0.0.1"),
            pkt(BASE + 1, src_mac="02:00:00:00:00:0a", src_ip="10.0.0.2"),
            pkt(BASE + 2, src_mac="02:00:00:00:00:0b", src_ip="10.0.0.2"),
            pkt(BASE + 3, src_mac="02:00:00:00:00:0b", src_ip="0.0.0.0")]
    mi = {r.mac: (r.ip_count, r.packets) for r in inventory.mac_inventory(packets(rows)).collect()}
    ii = {r.ip: (r.mac_count, r.packets) for r in inventory.ip_inventory(packets(rows)).collect()}
    assert mi == {"02:00:00:00:00:0a": (2, 2), "02:00:00:00:00:0b": (1, 1)}
    assert ii == {"10.0.0.1": (1, 1), "10.0.0.2": (2, 2)}


def test_summary_score_and_zero_rows(packets):
    # one reply mismatch and one unsolicited reply only
    rows = [pkt(BASE, opcode=2, eth_dst="02:00:00:00:00:09", src_mac="02:00:00:00:00:99")]
    res = batch.run_batch(packets(rows))
    summary = {r.detector: (r.detections, r.status) for r in res.summary().collect()}
    assert len(summary) == 9
    assert summary["spoof_reply_mismatch"] == (1, "ALERT") and summary["unsolicited"] == (1, "ALERT")
    assert summary["scanning"] == (0, "Clean")
    t = res.threat().first()
    assert (t.threat_score, t.threat_level, t.detectors_firing) == (32, "ELEVATED", 2)


def test_threat_score_caps(packets):
    # impersonation alone weighs 100
    rows = [pkt(BASE, src_ip="10.0.0.1"), pkt(BASE + 1, src_ip="10.0.0.2")]
    t = batch.run_batch(packets(rows)).threat().first()
    assert t.threat_score == 100 and t.threat_level == "CRITICAL"


def test_alert_json_records(packets):
    rows = [pkt(BASE, opcode=2, eth_dst="02:00:00:00:00:09", src_mac="02:00:00:00:00:99")]
    recs = report.alerts_json(batch.run_batch(packets(rows)).alerts).collect()
    assert {r.key for r in recs} == {"spoof_reply_mismatch", "unsolicited"}
    assert all(r.value.startswith('{"detector":') for r in recs)


def test_chart_frames_are_projections(packets):
    rows = [pkt(BASE + i / 100, dst_ip=f"10.0.0.{i}") for i in range(60)]
    frames = report.chart_frames(batch.run_batch(packets(rows)).detections)
    assert frames["scan_scatter"].columns == ["window_start", "window_end", "scanner_mac", "unique_targets",
                                               "total_requests", "targeted_ip_count"]
    assert frames["flood_line"].count() == 1
