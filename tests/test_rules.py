"""Window rules at and around their thresholds and window edges (golden cases)."""

from __future__ import annotations

import random

import brute
from conftest import BASE, pkt

from lansight.operators import rules
from pyspark.sql import functions as F


def _secs(df, col):
    return sorted(int(r[0]) for r in df.select(F.unix_seconds(col)).collect())


def test_scanning_threshold_edges(packets):
    rows = []
    # three separate 20-s blocks: 14, 15 and 16 distinct targets, each inside one 5-s pane
    for block, n in enumerate((14, 15, 16)):
        t0 = BASE + 100 * block + 1
        rows += [pkt(t0 + (i % 3), dst_ip=f"10.0.1.{i}") for i in range(n)]
        rows += [pkt(t0, dst_ip="10.0.1.0")]  # repeat target
        rows += [pkt(t0, eth_dst="02:00:00:00:00:02", dst_ip=f"10.0.9.{i}") for i in range(20)]  # unicast
    out = rules.detect_scanning(packets(rows))
    res = out.select(F.unix_seconds("window_start").alias("ws"), "unique_targets", "total_requests",
                     "targeted_ip_count").collect()
    # each hit block lies in two sliding windows
    assert sorted((r.ws - BASE, r.unique_targets, r.total_requests) for r in res) == [
        (95, 15, 16), (100, 15, 16), (195, 16, 17), (200, 16, 17)]
    assert all(r.unique_targets == r.targeted_ip_count for r in res)


def test_flood_edges(packets):
    rows = []
    for block, n in enumerate((49, 50, 51)):
        rows += [pkt(BASE + 10 * block + i / 100.0, dst_ip=f"10.0.2.{i % 7}") for i in range(n)]
    # 50 requests split over a second edge: 25 + 25 -> no hit
    rows += [pkt(BASE + 40.5 + i / 50.0, eth_src="02:00:00:00:00:05") for i in range(50)]
    out = rules.detect_flood(packets(rows)).collect()
    assert sorted((int(r.second.timestamp()) - BASE, r.requests_per_sec, r.unique_targets) for r in out) == [
        (10, 50, 7), (20, 51, 7)]


def test_garp_forms_and_counts(packets):
    forms = ["True", " TRUE ", "1", "yes", "t", "y", "no", "0", "", None]
    rows = [pkt(BASE + i, opcode=None, src_ip=f"10.0.0.{i % 2}", garp=g) for i, g in enumerate(forms)]
    out = rules.detect_garp(packets(rows)).collect()
    assert [(r.garp_count, r.claimed_ip_count) for r in out] == [(6, 2)]
    storm = rules.detect_garp_storm(packets(rows)).collect()
    assert [r.garp_count for r in storm] == [6]  # more than 5 in 10 s


def test_three_valued_or_lets_gratuitous_with_null_opcode_through(packets):
    rows = [pkt(BASE + 1, opcode=None, src_mac="02:00:00:00:00:a1", garp="True"),
            pkt(BASE + 2, opcode=None, src_mac="02:00:00:00:00:a2", garp="True")]
    out = rules.detect_mac_flipping(packets(rows)).collect()
    assert [(r.unique_arp_macs, r.identity_count, r.packet_count) for r in out] == [(2, 2, 2)]


def test_mac_flipping_ignores_zero_and_null_sender(packets):
    e = "02:00:00:00:00:01"
    rows = [pkt(BASE + 1, eth_src=e, opcode=2, src_mac="02:00:00:00:00:a1"),
            pkt(BASE + 2, eth_src=e, opcode=2, src_mac="00:00:00:00:00:00"),
            pkt(BASE + 3, eth_src=e, opcode=2, src_mac=None)]
    rows[2] = rows[2][:4] + (None,) + rows[2][5:]
    assert rules.detect_mac_flipping(packets(rows)).count() == 0
    rows.append(pkt(BASE + 4, eth_src=e, opcode=2, src_mac="02:00:00:00:00:a2", src_ip=None))
    r = rules.detect_mac_flipping(packets(rows)).first()
    assert (r.unique_arp_macs, r.unique_arp_ips, r.identity_count, r.packet_count) == (2, 1, 2, 2)


def test_ip_flipping_vs_impersonation_on_probe(packets):
    # a 0.0.0.0 probe then the host's own address: impersonation, not IP flipping
    rows = [pkt(BASE + 1, src_ip="0.0.0.0"), pkt(BASE + 2, src_ip="10.0.0.7")]
    p = packets(rows)
    assert rules.detect_ip_flipping(p).count() == 0
    r = rules.detect_impersonation(p).first()
    assert (r.unique_src_ips, r.unique_arp_macs, r.identity_count, r.total_packets) == (2, 1, 2, 2)


def test_identity_pairs_count_null_ips(packets):
    rows = [pkt(BASE + 1, src_ip=None), pkt(BASE + 2, src_ip="10.0.0.1"), pkt(BASE + 3, src_ip="10.0.0.2")]
    r = rules.detect_impersonation(packets(rows)).first()
    assert (r.unique_src_ips, r.identity_count) == (2, 3)


def test_conflict_inside_and_across_edge(packets):
    rows = [pkt(BASE + 1, eth_src="02:00:00:00:00:01", opcode=2, src_ip="10.0.0.5"),
            pkt(BASE + 9, eth_src="02:00:00:00:00:02", opcode=2, src_ip="10.0.0.5"),
            pkt(BASE + 19, eth_src="02:00:00:00:00:01", opcode=2, src_ip="10.0.0.6"),
            pkt(BASE + 20, eth_src="02:00:00:00:00:02", opcode=2, src_ip="10.0.0.6")]
    out = rules.detect_conflicts(packets(rows)).collect()
    assert [(r.contested_ip, r.claiming_mac_count, r.mac_count, r.claim_count) for r in out] == [("10.0.0.5", 2, 2, 2)]


def test_family_equals_single_rules(packets):
    rng = random.Random(7)
    rows = [pkt(BASE + rng.randrange(90), eth_src=f"02:00:00:00:00:0{rng.randrange(3)}", opcode=rng.choice([1, 2, None]),
                src_mac=rng.choice(["02:00:00:00:00:0a", "02:00:00:00:00:0b", "00:00:00:00:00:00", None]),
                src_ip=rng.choice(["10.0.0.1", "10.0.0.2", "0.0.0.0", None]), garp=rng.choice([None, "True"]))
            for _ in range(400)]
    p = packets(rows)
    fam = rules.detect_identity_family(p)
    single = {"spoof_mac_flipping": rules.detect_mac_flipping(p), "spoof_ip_flipping": rules.detect_ip_flipping(p),
              "impersonation": rules.detect_impersonation(p)}
    for k, df in single.items():
        assert sorted(map(tuple, fam[k].collect())) == sorted(map(tuple, df.collect())), k


def test_rules_match_brute_force(packets):
    rng = random.Random(11)
    rows = []
    for _ in range(3000):
        rows.append(pkt(BASE + rng.random() * 60, eth_src=f"02:00:00:00:00:0{rng.randrange(4)}",
                        eth_dst=rng.choice(["ff:ff:ff:ff:ff:ff", "02:00:00:00:00:09"]), opcode=rng.choice([1, 1, 2]),
                        src_ip=rng.choice(["10.0.0.1", "10.0.0.2", "0.0.0.0", None]),
                        src_mac=rng.choice([None, "02:00:00:00:00:0a"]),
                        dst_ip=f"10.0.1.{rng.randrange(30)}"))
    rows = [r if r[4] is not None else r[:4] + (r[1],) + r[5:] for r in rows]
    p = packets(rows)
    pk = brute.norm(rows)
    got = {(int(r.window_start.timestamp()), r.scanner_mac, r.unique_targets, r.total_requests,
            int(r.window_first_ts.timestamp()), int(r.window_last_ts.timestamp()))
           for r in rules.detect_scanning(p).collect()}
    assert got == brute.scanning(pk) and got
    low = rules.DEFAULT.with_(flood_requests=10)
    got = {(int(r.second.timestamp()), r.mac, r.requests_per_sec, r.unique_targets)
           for r in rules.detect_flood(p, low).collect()}
    assert got == brute.flood(pk, thr=10) and got
    got = {(int(r.window_start.timestamp()), r.mac, r.unique_src_ips, r.unique_arp_macs, r.identity_count,
            r.total_packets) for r in rules.detect_impersonation(p).collect()}
    assert got == brute.impersonation(pk) and got


def test_reply_mismatch_forms(packets):
    from lansight.operators import events
    e = "02:00:00:00:00:01"
    rows = [pkt(BASE, eth_src=e, opcode=2, src_mac=e),                       # equal
            pkt(BASE + 1, eth_src=e, opcode=2, src_mac="02:00:00:00:00:99"),  # forged
            pkt(BASE + 2, eth_src=e, opcode=2, src_mac="00:00:00:00:00:00"),  # unset sender
            pkt(BASE + 3, eth_src=e, opcode=2, src_mac="02:00:00:00:00:01".upper()),  # case only
            pkt(BASE + 4, eth_src=e, opcode=1, src_mac="02:00:00:00:00:98")]  # a request
    rows.append(pkt(BASE + 5, eth_src=e, opcode=2)[:4] + (None,) + pkt(BASE)[5:])  # null sender
    p = packets(rows)
    out = [(r.real_mac, r.claimed_mac) for r in events.detect_reply_mismatch(p).collect()]
    assert out == [(e, "02:00:00:00:00:99")]
    req = [(r.claimed_mac, r.spoof_heuristic) for r in events.detect_spoofed_requests(p).collect()]
    assert req == [("02:00:00:00:00:98", "Request MAC mismatch")]
