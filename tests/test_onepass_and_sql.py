"""The one-pass alert table, panes with sketches, SQL table functions and archive compaction."""

from __future__ import annotations

import math
import random

import pytest
from conftest import BASE, pkt
from pyspark.sql import functions as F

from lansight.config import DEFAULT
from lansight.functions.normalize import enrich
from lansight.operators import rules
from lansight.operators.panes import compile_panes, hll_error, pane_table, windows_of_panes
from lansight.operators.talkers import sketch_error, window_top_talkers
from lansight.plans import batch, onepass, report, sql_functions
from lansight.schema import RAW_SCHEMA
from lansight.session import scratch_path
from lansight.sources import archive


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def packets_with_everything(seed=1, n=4000):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        mac = f"02:00:00:00:00:0{rng.randrange(1, 5)}"
        rows.append(pkt(rng.choice([None, BASE + rng.randrange(0, 150) + rng.random()]) if rng.random() < .05
                        else BASE + rng.randrange(0, 150), eth_src=rng.choice([mac, mac, mac, None]),
                        eth_dst=rng.choice(["ff:ff:ff:ff:ff:ff", "02:00:00:00:00:01", None]),
                        opcode=rng.choice([1, 1, 1, 2, 2, 3, None]),
                        src_mac=rng.choice([mac, mac, "02:00:00:00:00:99", "00:00:00:00:00:00", ""]),
                        src_ip=rng.choice([f"10.0.0.{rng.randrange(4)}", "0.0.0.0", None]),
                        dst_ip=rng.choice([f"10.0.0.{rng.randrange(40)}", None]), garp=rng.choice([None, None, "True", "no"])))
    return rows + rows[:50]


CONFIGS = [DEFAULT, DEFAULT.with_(flood_requests=2, scan_unique_targets=4, scan_slide=3, unsolicited_lookback=9),
           DEFAULT.with_(impersonation_exclude_unset=True, conflict_window=7, garp_count=5),
           DEFAULT.with_(time_precision="micros", scan_unique_targets=3, flood_requests=3)]


@pytest.mark.parametrize("cfg", CONFIGS, ids=range(len(CONFIGS)))
def test_one_pass_gives_the_detectors_alerts(packets, cfg):
    p = packets(packets_with_everything(), cfg)
    detections = batch.detections(p, cfg)
    want = rows_of(report.alerts_unified(detections))
    got = rows_of(onepass.alerts(p, cfg).select(*report.ALERT_COLUMNS))
    assert len({r[0] for r in want}) >= 7 and got == want
    assert onepass.counts(p, cfg).first().asDict() == report.counts_of(detections).first().asDict()


def test_one_pass_reads_the_packets_twice_at_most(spark, raw_df):
    path = scratch_path(spark, "onepass")
    archive.write_archive(raw_df(packets_with_everything(n=100)), path)
    p = enrich(archive.read_archive(spark, path))
    for df in (onepass.alerts(p), report.score_of(onepass.counts(p)), batch.run_batch(p).alerts):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") <= 2, plan
        assert "collect_set" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_one_pass_on_no_packets(packets):
    p = packets([]) if False else packets([pkt(BASE)]).limit(0)
    assert onepass.alerts(p).count() == 0
    assert report.score_of(onepass.counts(p)).first().threat_score == 0


def test_panes_count_each_packet_once_and_stay_within_the_stated_error(spark, packets):
    rng = random.Random(3)
    rows = [pkt(BASE + rng.randrange(60), dst_ip=f"10.{rng.randrange(40)}.{rng.randrange(40)}.{rng.randrange(30)}",
                eth_src=f"02:00:00:00:00:0{rng.randrange(2)}") for _ in range(30_000)]
    p = packets(rows)
    rule = rules.scanning_rule()
    assert pane_table(p, rule).agg({"packets": "sum"}).first()[0] == 30_000
    exact = {(r.window_start, r.scanner_mac): r for r in rules.compile_batch(p, rule).collect()}
    got = compile_panes(p, rule).collect()
    assert len(got) == len(exact) > 20
    for r in got:
        e = exact[r.window_start, r.scanner_mac]
        assert (r.total_requests, r.window_first_ts, r.window_last_ts) == (e.total_requests, e.window_first_ts, e.window_last_ts)
        assert abs(r.unique_targets - e.unique_targets) <= 4 * hll_error() * e.unique_targets
    # panes can be written and merged into other windows later
    wide = rules.scanning_rule(DEFAULT.with_(scan_window=30))
    path = scratch_path(spark, "panes")
    pane_table(p, rule).write.parquet(path)
    assert rows_of(windows_of_panes(spark.read.parquet(path), wide)) == rows_of(compile_panes(p, wide))


def test_window_talkers_hold_the_true_ones_within_the_stated_bounds(packets):
    rng = random.Random(6)
    rows = []
    for i in range(12_000):  # one sender with a third, a few busy ones, thousands of forged senders
        sender = 0 if i % 3 == 0 else rng.randrange(1, 9) if rng.random() < .5 else rng.randrange(100, 9000)
        rows.append(pkt(BASE + i % 120, eth_src=f"02:00:00:00:{sender // 256:02x}:{sender % 256:02x}"))
    p = packets(rows)
    true = {}
    for r in p.groupBy(F.window("event_ts", "60 seconds").alias("w"), "eth_src").count().collect():
        true.setdefault(r.w.start, {})[r.eth_src] = r["count"]
    for capacity, exact in ((64, False), (8192, True)):
        got = {}
        for r in window_top_talkers(p, k=5, capacity=capacity).collect():
            got.setdefault(r.window_start, {})[r.eth_src] = r
        assert set(got) == set(true) and len(true) == 2
        for w, counts in true.items():
            top = sorted(counts, key=lambda m: -counts[m])[:5]
            assert set(top) <= set(got[w])
            for mac, r in got[w].items():
                assert counts[mac] <= r.packet_count <= counts[mac] + r.max_error
                assert r.max_error == (0 if exact else math.ceil(sketch_error(capacity) * 6000))
            if exact:
                assert set(got[w]) == {m for m in counts if counts[m] >= counts[top[-1]]}


def test_table_functions_take_windows_and_thresholds(spark, packets):
    p = packets(packets_with_everything(5))
    names = sql_functions.register_functions(p)
    cfg = DEFAULT.with_(scan_window=20, scan_slide=5, scan_unique_targets=6, flood_window=2, flood_requests=3,
                        garp_window=30, garp_count=4, conflict_window=5)
    calls = {"scanning": ((20, 5, 6), rules.detect_scanning), "flood": ((2, 3), rules.detect_flood),
             "garp": ((30, 4), rules.detect_garp), "conflict": ((5, 2), rules.detect_conflicts),
             "mac_flipping": ((30, 2), rules.detect_mac_flipping)}
    assert sorted(names) == sorted(calls)
    for name, (args, detect) in calls.items():
        want = detect(p, cfg)
        got = sql_functions.call(spark, name, *args)
        assert want.count() > 0 and got.columns == want.columns and rows_of(got) == rows_of(want), name
    by_default = spark.sql("SELECT mac, count(*) AS n FROM garp() GROUP BY mac")
    assert rows_of(by_default) == rows_of(rules.detect_garp(p).groupBy("mac").count())


def test_an_archive_is_compacted_once(spark):
    path = scratch_path(spark, "compact")
    rows = [pkt(BASE + 40_000 * (i % 5) + i, eth_src=f"02:00:00:00:00:{i % 60:02d}") for i in range(1000)] + [pkt(None)]
    for part in range(4):
        archive.write_archive(spark.createDataFrame(rows[part::4], RAW_SCHEMA).repartition(6), path)
    before = rows_of(archive.read_archive(spark, path))
    many = {r.date: r.files for r in archive.file_sizes(spark, path).collect()}
    assert max(many.values()) >= 20
    dates = archive.compact_archive(spark, path)
    few = {r.date: r.files for r in archive.file_sizes(spark, path).collect()}
    assert sorted(dates) == sorted(d for d in many if d) and all(few[d] == 1 for d in dates)
    assert few[None] == many[None]
    assert rows_of(archive.read_archive(spark, path)) == before
    assert archive.compact_archive(spark, path) == []
    # smaller files on request, as many as the size asks for
    size = max(r.bytes for r in archive.file_sizes(spark, path).collect() if r.date)
    archive.write_archive(spark.createDataFrame(rows[:50], RAW_SCHEMA).repartition(8), path)
    archive.compact_archive(spark, path, target_bytes=size // 3)
    files = {r.date: r.files for r in archive.file_sizes(spark, path).collect() if r.date}
    assert max(files.values()) > 1 and archive.read_archive(spark, path).count() == len(rows) + 50
