"""Captures with bad clocks, no packets, broken lines, and settings beyond the usual ones."""

from __future__ import annotations

import os
import shutil
from collections import Counter

import pytest
from conftest import BASE, pkt

from lansight.config import DEFAULT
from lansight.functions.normalize import enrich
from lansight.job import config_from, run_batch_job, run_stream_job
from lansight.operators import history, joins, traffic
from lansight.plans import batch, report
from lansight.session import scratch_path
from lansight.sources import archive
from lansight.streaming.compile import packet_stream, stream_ip_mac_remap, stream_unsolicited
from lansight.streaming.runner import MARKER_IP, MARKER_MAC, replay

DATA = os.path.join(os.path.dirname(__file__), "data")
BAD_CLOCKS = [1e13, 1e15, -1e15, 1.778e15, 1e18, -1e18, float("inf"), float("-inf"), float("nan"), None]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bad_clocks_become_null_times_and_one_partition(spark, packets, raw_df):
    rows = [pkt(t) for t in BAD_CLOCKS] + [pkt(BASE), pkt(0), pkt(-62135596800), pkt(253402300799)]
    for cfg in (DEFAULT, DEFAULT.with_(time_precision="micros")):
        assert packets(rows, cfg).where("event_ts IS NULL").count() == len(BAD_CLOCKS)
    path = scratch_path(spark, "bad-clocks")
    archive.write_archive(raw_df(rows), path)
    dates = {r.date: r["count"] for r in spark.read.parquet(path).groupBy("date").count().collect()}
    assert dates[None] == len(BAD_CLOCKS) and len(dates) == 5
    assert archive.read_archive(spark, path).count() == len(rows)


def _capture(path, extra):
    os.makedirs(path)
    with open(os.path.join(DATA, "story.csv")) as f:
        lines = f.read().rstrip("\n").split("\n")
    with open(f"{path}/story.csv", "w") as f:
        f.write("\n".join(lines + extra) + "\n")


def test_batch_and_stream_jobs_outlive_bad_clocks_and_broken_lines(spark):
    inbox, out = scratch_path(spark, "job-bad-in"), scratch_path(spark, "job-bad-out")
    mac = "02:00:00:00:00:77"
    _capture(inbox, [f"{t},{mac},ff:ff:ff:ff:ff:ff,1,{mac},10.0.0.9,00:00:00:00:00:00,10.0.0.1,"
                     for t in ("1e15", "1e18", "-1e18", "1e13", "Infinity", "NaN")] + ["broken,line,only"])
    run_batch_job(spark, inbox, out)
    lines = [r.line for r in spark.read.parquet(f"{out}/corrupt").collect()]
    assert any("broken,line,only" in x for x in lines)
    clean, plain = scratch_path(spark, "job-clean-out"), os.path.join(DATA, "story.csv")
    run_batch_job(spark, plain, clean)
    for name in ("scanning", "flood", "unsolicited", "conflict"):
        assert rows_of(spark.read.parquet(f"{out}/detections/{name}")) == \
            rows_of(spark.read.parquet(f"{clean}/detections/{name}"))
    totals = spark.read.parquet(f"{out}/profile/totals").first()
    assert totals.total == 267
    for name in ("timeline", "top_talkers", "opcode"):
        assert spark.read.parquet(f"{out}/profile/{name}").count() > 0


def test_an_empty_capture_gives_empty_results(spark):
    out = scratch_path(spark, "job-empty")
    run_batch_job(spark, os.path.join(DATA, "empty"), out)
    assert spark.read.parquet(f"{out}/alerts").count() == 0
    assert spark.read.parquet(f"{out}/threat").first().threat_score == 0
    assert spark.read.parquet(f"{out}/profile/timeline").count() == 0


def test_stream_jobs_keep_their_checkpoints_with_their_output(spark):
    outs = []
    for i in range(2):
        inbox, out = scratch_path(spark, f"stream-in-{i}"), scratch_path(spark, f"stream-out-{i}")
        os.makedirs(inbox)
        shutil.copy(os.path.join(DATA, "story.csv"), inbox)
        run_stream_job(spark, inbox, out, once=True)
        outs.append((inbox, out))
    for inbox, out in outs:
        first = spark.read.parquet(f"{out}/silver").count()
        run_stream_job(spark, inbox, out, once=True)
        assert spark.read.parquet(f"{out}/silver").count() == first == 260
        assert os.path.isdir(f"{out}/_checkpoints/ingest")


def test_replies_without_a_time_or_address_are_unsolicited_on_a_stream_too(spark, raw_df):
    rows = [pkt(BASE, opcode=2, src_ip="10.0.0.5", dst_ip="10.0.0.6"), pkt(None, opcode=2), pkt(1e15, opcode=2),
            pkt(BASE + 1, opcode=2, src_ip=None), pkt(BASE + 2, opcode=2, src_ip="10.0.0.9", dst_ip="10.0.0.1"),
            pkt(BASE + 1, opcode=1, src_ip="10.0.0.1", dst_ip="10.0.0.9")]
    want = rows_of(joins.detect_unsolicited(enrich(raw_df(rows))))
    got, _ = replay(spark, raw_df(rows), lambda s: stream_unsolicited(packet_stream(s)), "null-replies", slices=2)
    assert rows_of(got) == want and len(want) == 4


def test_a_real_packet_with_the_marker_address_survives_a_replay(spark, raw_df):
    rows = [pkt(BASE + i, opcode=2, eth_src=MARKER_MAC, src_ip=MARKER_IP, dst_ip=MARKER_IP) for i in range(3)]
    want = rows_of(joins.detect_unsolicited(enrich(raw_df(rows))))
    got, _ = replay(spark, raw_df(rows), lambda s: stream_unsolicited(packet_stream(s)), "marker", slices=1)
    assert rows_of(got) == want and len(want) == 3


def test_equal_time_claims_have_one_order(spark, raw_df):
    rows = [pkt(BASE, opcode=2, src_mac="02:00:00:00:00:0a")] + [
        pkt(BASE + 5, opcode=2, eth_src=f"02:00:00:00:00:0{i}", src_mac="02:00:00:00:00:0b") for i in (3, 1, 2)]
    answers = {tuple(map(tuple, rows_of(history.ip_mac_remap(enrich(raw_df(x)))))) for x in (rows, rows[::-1])}
    assert len(answers) == 1 and next(iter(answers))[0][4] == "02:00:00:00:00:01"
    got, _ = replay(spark, raw_df(rows[::-1]), lambda s: stream_ip_mac_remap(packet_stream(s)), "ties", slices=1)
    assert {r.eth_src for r in got.collect()} == {"02:00:00:00:00:01"}


def test_claims_out_of_order_within_the_watermark_are_put_in_order(spark, raw_df):
    from lansight.config import DEFAULT as cfg
    from lansight.schema import RAW_SCHEMA
    from lansight.sources import csv
    from lansight.streaming.sinks import file_sink

    claim = lambda t, m: pkt(BASE + t, opcode=2, src_mac=f"02:00:00:00:00:{m}")
    parts = [[claim(0, "aa")], [claim(10, "aa")], [claim(5, "bb")], [claim(100_000, "aa")]]
    want = rows_of(history.ip_mac_remap(enrich(raw_df(sum(parts, [])))))
    root = scratch_path(spark, "late-claims")
    for part in parts:
        csv.write_csv(spark.createDataFrame(part, RAW_SCHEMA).coalesce(1), f"{root}/in")
        stream = csv.read_csv_stream(spark, f"{root}/in", cfg, max_files_per_trigger=1)
        file_sink(stream_ip_mac_remap(packet_stream(stream)), f"{root}/out", f"{root}/ckpt") \
            .trigger(availableNow=True).start().awaitTermination()
    got = rows_of(spark.read.parquet(f"{root}/out"))
    assert len(want) == 2 and got == want


def _brute_by_mac(rows, lookback):
    """Replies without a request from their target MAC for their sender IP less than ``lookback`` before."""
    out = Counter()
    for r in rows:
        if r[3] == 2 and not any(q[3] == 1 and q[7] == r[5] and q[1] == r[6] and 0 <= r[0] - q[0] < lookback for q in rows):
            out[r[1], r[5]] += 1
    return out


@pytest.mark.parametrize("lookback", [2, 62, 63, 120, 4000])
@pytest.mark.parametrize("precision", ["seconds", "micros"])
def test_any_look_back_and_precision(packets, lookback, precision):
    import random

    rnd = random.Random(lookback)
    macs = [f"02:00:00:00:00:0{i}" for i in range(3)]
    rows = [pkt(BASE + rnd.randrange(0, 9000) * (1 if precision == "seconds" else 0.25), eth_src=rnd.choice(macs),
                opcode=rnd.choice((1, 2)), src_ip=f"10.0.0.{rnd.randrange(3)}", dst_mac=rnd.choice(macs),
                dst_ip=f"10.0.0.{rnd.randrange(3)}") for _ in range(150)]
    cfg = DEFAULT.with_(unsolicited_mac_lookback=lookback, time_precision=precision)
    got = Counter((r.mac, r.ip) for r in joins.detect_unsolicited_by_mac(packets(rows, cfg), cfg).collect())
    assert got == _brute_by_mac(rows, lookback)


def test_alert_details_keep_their_other_parts(packets):
    rows = [pkt(BASE, opcode=2, src_ip=None, src_mac="02:00:00:00:00:0c")]
    alerts = batch.run_batch(packets(rows)).alerts.where("detector = 'unsolicited'").collect()
    assert alerts[0].detail == "ip=null advertised_mac=02:00:00:00:00:0c"
    frames = report.chart_frames(batch.run_batch(packets(rows)).detections)
    assert {"total_requests", "targeted_ip_count", "window_end"} <= set(frames["scan_scatter"].columns)


def test_timeline_of_a_long_gap_is_dense_and_scans_once(packets):
    rows = [pkt(BASE), pkt(BASE + 90_000), pkt(BASE + 180_001)]
    df = traffic.traffic_timeline(packets(rows))
    assert df.count() == 180_002 and df.where("requests > 0").count() == 3
    rate = traffic.packet_rate(packets(rows)).first()
    assert rate.span_seconds == 180_002 and rate.idle_seconds == 179_999


def test_settings_from_the_command_line():
    cfg = config_from(["flood_requests=80", "time_precision=micros", "impersonation_exclude_unset=true",
                       "threat_weights.flood=7", "max_files_per_trigger=20"])
    assert (cfg.flood_requests, cfg.time_precision, cfg.impersonation_exclude_unset, cfg.max_files_per_trigger) == (
        80, "micros", True, 20)
    assert cfg.threat_weights["flood"] == 7 and cfg.threat_weights["garp"] == DEFAULT.threat_weights["garp"]
    for bad in ("nothing=1", "flood_requests", "threat_weights.none=1"):
        with pytest.raises(ValueError):
            config_from([bad])
