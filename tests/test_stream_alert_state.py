"""The live alert table keeps few states, in no more partitions than a replay's packets need."""

from __future__ import annotations

import os

import pytest
from conftest import BASE, pkt

from lansight.config import DEFAULT
from lansight.functions.normalize import enrich
from lansight.plans import batch, report
from lansight.schema import RAW_SCHEMA
from lansight.session import scratch_path, session_conf
from lansight.sources import csv
from lansight.streaming import compile as sc
from lansight.streaming.runner import replay, state_partitions
from lansight.streaming.sinks import file_sink

LOW = DEFAULT.with_(scan_unique_targets=2, flood_requests=2)


def _rows(start, n=60):
    """Packets of three senders that meet every rule, some without an address, and null values."""
    out = []
    for i in range(n):
        mac, t = f"02:00:00:00:00:0{i % 3 + 1}", start + i // 2
        out.append(pkt(t, eth_src=mac, src_ip=f"10.0.0.{i % 4}", dst_ip=f"10.0.1.{i % 7}"))
        out.append(pkt(t, eth_src=mac, opcode=2, src_mac=f"02:00:00:00:01:0{i % 5}", src_ip="10.0.0.9",
                       dst_ip=None if i % 6 == 0 else "10.0.0.1", garp="1" if i % 4 == 0 else None))
        out.append(pkt(t, eth_src=mac, src_ip=None, dst_ip=None))
    return out


def _ordered(df):
    return sorted(map(str, df.select(*report.ALERT_COLUMNS).collect()))


def test_window_rules_share_one_chain_of_aggregates(spark, tmp_path):
    plan = sc.stream_alerts(sc.packet_stream(csv.read_csv_stream(spark, str(tmp_path))))
    assert plan._jdf.queryExecution().analyzed().toString().count("Aggregate [") <= 4


@pytest.mark.parametrize("cfg", [LOW, LOW.with_(flood_window=30, time_precision="micros")])
def test_alerts_where_rules_share_a_window(spark, cfg):
    # a flood window of 30 s puts three columns' distinct values on one window and sender
    raw = spark.createDataFrame(_rows(BASE) + [pkt(None, opcode=2, src_mac="02:00:00:00:00:07")], RAW_SCHEMA)
    got, _ = replay(spark, raw, lambda s: sc.stream_alerts(sc.packet_stream(s, cfg), cfg), "shared", slices=2)
    want = batch.run_batch(enrich(raw, cfg), cfg).alerts
    assert want.select("detector").distinct().count() == 9 and _ordered(got) == _ordered(want)


def test_late_packets_count_where_their_own_window_is_open(spark):
    """Late by up to 70 s: windows of 1 to 60 s are final or not, as with a query per rule."""
    slices = [_rows(BASE), _rows(BASE + 60, 10), [p for late in (2, 20, 31, 44, 50, 58) for p in _rows(BASE + late, 2)],
              [pkt(BASE + 100_000)], [pkt(BASE + 200_000)]]
    builds = {"folded": lambda p: sc.stream_alerts(p, LOW),
              "each": lambda p: report.alerts_unified(sc.stream_detections(p, LOW))}
    found = {}
    for name, build in builds.items():
        root = scratch_path(spark, f"late-{name}")
        for rows in slices:
            csv.write_csv(spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1), f"{root}/inbox")
            stream = sc.packet_stream(csv.read_csv_stream(spark, f"{root}/inbox", max_files_per_trigger=1), LOW)
            file_sink(build(stream), f"{root}/out", f"{root}/ckpt").trigger(availableNow=True).start().awaitTermination()
        found[name] = _ordered(spark.read.parquet(f"{root}/out"))
    assert found["folded"] == found["each"] and len(found["each"]) > 50


def test_a_replay_opens_no_more_state_than_its_packets_need(spark):
    cores = spark.sparkContext.defaultParallelism
    raw = spark.createDataFrame(_rows(BASE), RAW_SCHEMA)
    with session_conf(spark, {"spark.sql.shuffle.partitions": "40"}):
        assert state_partitions(spark, 10) == cores and state_partitions(spark, 10_000_000_000) == 40
        assert state_partitions(spark, 6_000_000) == 30
        _, rp = replay(spark, raw, lambda s: sc.stream_mac_flap(sc.packet_stream(s)), "few", slices=2)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    opened = [x for x in os.listdir(f"{rp.checkpoint}/state/0") if x.isdigit()]
    assert len(opened) == cores
