from __future__ import annotations

from datetime import datetime

from conftest import BASE, pkt

from lansight.config import ArpConfig
from lansight.functions.timefn import to_ntz
from pyspark.sql import functions as F


def _rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_gratuitous_spellings_and_nulls(packets):
    forms = ["True", " TRUE ", "1", "yes", "t", "y", "no", "0", "", None]
    df = packets([pkt(BASE + i, garp=g) for i, g in enumerate(forms)])
    got = [r[0] for r in df.orderBy("epoch_ts").select("is_gratuitous").collect()]
    assert got == [True] * 6 + [False, False, False, None]


def test_macs_lowered_ips_only_trimmed(packets):
    df = packets([pkt(BASE, eth_src=" 02:AA:00:00:00:01 ", src_mac="02:AA:00:00:00:01", src_ip=" 10.0.0.1 ",
                      dst_ip=" 10.0.0.X ")])
    r = df.first()
    assert r.eth_src == "02:aa:00:00:00:01" and r.arp_src_mac == "02:aa:00:00:00:01"
    assert r.arp_src_ip == "10.0.0.1" and r.arp_dst_ip == "10.0.0.X"
    assert r.has_mac_mismatch is False


def test_flags_three_valued(packets):
    rows = [pkt(BASE, opcode=1), pkt(BASE, opcode=2, eth_dst="02:00:00:00:00:09"), pkt(BASE, opcode=None)]
    got = _rows(packets(rows).orderBy(F.col("opcode").asc_nulls_last()), "is_request", "is_reply", "is_broadcast")
    assert got == [(True, False, True), (False, True, False), (None, None, True)]


def test_mismatch_ignores_zero_and_null_sender(packets):
    rows = [pkt(BASE, src_mac="02:00:00:00:00:99"), pkt(BASE + 1, src_mac="00:00:00:00:00:00"),
            pkt(BASE + 2, src_mac=None)]
    rows[2] = rows[2][:4] + (None,) + rows[2][5:]
    got = [r[0] for r in packets(rows).orderBy("epoch_ts").select("has_mac_mismatch").collect()]
    assert got == [True, False, False]


def test_event_time_truncated_to_seconds_and_bad_epochs_null(packets):
    rows = [pkt(BASE + 0.999), pkt(float("nan")), pkt(None)]
    df = packets(rows).select(to_ntz(F.col("event_ts")).alias("t"), "epoch_ts")
    got = sorted((r.t for r in df.collect()), key=lambda x: (x is None, x))
    assert got[0] == datetime(2026, 5, 5, 20, 44, 0) and got[1:] == [None, None]


def test_micro_precision_option(packets):
    df = packets([pkt(BASE + 0.5)], ArpConfig(time_precision="micros"))
    assert df.select(F.unix_micros("event_ts")).first()[0] == (BASE * 1_000_000 + 500_000)


def test_ntz_boundary_ignores_session_zone(spark, packets):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        t = packets([pkt(BASE)]).select(to_ntz(F.col("event_ts"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert t == datetime(2026, 5, 5, 20, 44, 0)
