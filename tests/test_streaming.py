"""Stream = batch for the stateful detectors; the per-micro-batch mode differs;
late rows are dropped by the watermark."""

from __future__ import annotations

import random

from conftest import BASE, pkt

from lansight.functions.normalize import enrich
from lansight.operators import history, joins, rules
from lansight.schema import RAW_SCHEMA
from lansight.session import scratch_path
from lansight.sources import csv
from lansight.streaming import compile as sc
from lansight.streaming.runner import microbatch_alerts, replay


def _capture(spark):
    rng = random.Random(21)
    rows = []
    for i in range(1200):
        t = BASE + i * 0.1
        if rng.random() < 0.4:
            rows.append(pkt(t, eth_src="02:00:00:00:00:66", dst_ip=f"10.0.1.{rng.randrange(40)}",
                            src_ip="10.0.0.66"))
        elif rng.random() < 0.5:
            a = rng.randrange(1, 5)
            rows.append(pkt(t, eth_src=f"02:00:00:00:00:0{a}", src_ip=f"10.0.0.{a}", dst_ip=f"10.0.0.{a % 4 + 1}"))
        else:
            a = rng.randrange(1, 5)
            rows.append(pkt(t, eth_src=f"02:00:00:00:00:0{a}", eth_dst="02:00:00:00:00:09", opcode=2,
                            src_ip=f"10.0.0.{a}", dst_ip=f"10.0.0.{(a + 1) % 4 + 1}",
                            src_mac=rng.choice([f"02:00:00:00:00:0{a}", "02:00:00:00:00:99"])))
    return spark.createDataFrame(rows, RAW_SCHEMA)


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_stream_equals_batch(spark):
    raw = _capture(spark)
    p = enrich(raw)
    for rule in (rules.scanning_rule(), rules.impersonation_rule(), rules.conflict_rule()):
        out, rp = replay(spark, raw, lambda s, r=rule: sc.stream_rule(sc.packet_stream(s), r), rule.name, slices=3)
        batch = rules.compile_batch(p, rule)
        assert batch.count() > 0 and _same(out.select(*batch.columns), batch), rule.name
        assert rp.batches == 4
    out, _ = replay(spark, raw, lambda s: sc.stream_unsolicited(sc.packet_stream(s)), "unsolicited", slices=3)
    assert _same(out, joins.detect_unsolicited(p))
    out, _ = replay(spark, raw, lambda s: sc.stream_ip_mac_remap(sc.packet_stream(s)), "remap", slices=3)
    want = history.ip_mac_remap(p)
    assert want.count() > 0 and _same(out.select(*want.columns), want)


def test_microbatch_mode_differs(spark):
    raw = _capture(spark)
    root = scratch_path(spark, "test-microbatch")
    csv.write_csv(raw.repartitionByRange(6, raw["`frame.time_epoch`"]), f"{root}/inbox")
    q = microbatch_alerts(spark, csv.read_csv_stream(spark, f"{root}/inbox", max_files_per_trigger=1),
                          f"{root}/out", f"{root}/ckpt")
    q.awaitTermination()
    per_batch = spark.read.parquet(f"{root}/out")
    assert per_batch.select("batch_id").distinct().count() == 6
    n_unsol = per_batch.filter("detector = 'unsolicited'").count()
    assert n_unsol >= joins.detect_unsolicited(enrich(raw)).count()


def test_late_rows_are_dropped(spark):
    # three files, one per trigger: the watermark jumps after the second, the late row comes in the third
    root = scratch_path(spark, "test-late")
    batches = [
        [pkt(BASE + i, dst_ip=f"10.0.1.{i}") for i in range(3)],
        [pkt(BASE + 100, dst_ip="10.0.1.50")],
        [pkt(BASE + 101, dst_ip="10.0.1.51")],
        [pkt(BASE + 1, dst_ip="10.0.1.99")],  # 100 s behind the watermark
    ]
    q = None
    cfg = rules.DEFAULT.with_(flood_requests=1, flood_window=10)
    for rows in batches:
        csv.write_csv(spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1), f"{root}/inbox")
        stream = sc.packet_stream(csv.read_csv_stream(spark, f"{root}/inbox", max_files_per_trigger=1))
        agg = sc.stream_rule(stream, rules.flood_rule(cfg))
        q = (agg.writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])
    assert dropped == 1


def test_live_alert_table_equals_batch(spark):
    from lansight.plans import batch

    raw = _capture(spark)
    out, _ = replay(spark, raw, lambda s: sc.stream_alerts(sc.packet_stream(s)), "alerts", slices=2)
    want = batch.run_batch(enrich(raw)).alerts
    assert want.count() > 0 and _same(out.select(*want.columns), want)
