"""Guarded clocks, counts, restarts, early results and flapping on streams."""

from __future__ import annotations

import os
import random
import shutil

import pytest
from conftest import BASE, pkt

from lansight.config import DEFAULT
from lansight.functions.normalize import enrich
from lansight.job import run_batch_job, run_stream_job
from lansight.operators import history, rules
from lansight.operators.panes import compile_panes
from lansight.schema import RAW_SCHEMA
from lansight.session import scratch_path
from lansight.sources import archive, csv
from lansight.streaming import compile as sc
from lansight.streaming.early import early_sink, fold, latest, stream_rule_early, upsert_batch
from lansight.streaming.runner import replay
from lansight.streaming.sinks import console_sink, file_sink, memory_sink
from lansight.streaming.supervise import StreamCounts, Supervisor

DATA = os.path.join(os.path.dirname(__file__), "data")
FAR = 4_070_908_800.0  # 2099


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def capture(spark, n=900, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t, a = BASE + i * 0.2, rng.randrange(1, 4)
        mac = rng.choice([f"02:00:00:00:00:0{a}", "02:00:00:00:00:99"])
        rows.append(pkt(t, eth_src=f"02:00:00:00:00:0{a}", opcode=rng.choice([1, 1, 2, 2, 3, None]), src_mac=mac,
                        src_ip=rng.choice([f"10.0.0.{a}", "10.0.0.9", None]), dst_ip=f"10.0.1.{rng.randrange(40)}",
                        garp=rng.choice([None, None, None, "True"])))
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_a_packet_dated_2099_leaves_the_other_packets_answer(spark):
    raw = capture(spark)
    ahead = spark.createDataFrame([pkt(FAR, dst_ip="10.0.1.1")], RAW_SCHEMA)
    rule = rules.flood_rule(DEFAULT.with_(flood_requests=1))
    want = rows_of(rules.compile_batch(enrich(raw), rule))
    build = lambda s: sc.stream_rule(sc.packet_stream(s), rule)
    guarded, _ = replay(spark, raw, build, "guarded", first=ahead, arrival=True)
    assert len(want) > 100 and rows_of(guarded) == want
    bare, _ = replay(spark, raw, build, "bare", first=ahead)
    assert len(rows_of(bare)) < len(want) / 2  # what the guard prevents


def _inbox(spark, extra):
    inbox = scratch_path(spark, "guard-in")
    os.makedirs(inbox)
    with open(os.path.join(DATA, "story.csv")) as f:
        lines = f.read().rstrip("\n").split("\n")
    half = len(lines) // 2
    for i, part in enumerate((lines[1:half] + extra, lines[half:])):
        with open(f"{inbox}/part{i}.csv", "w") as f:
            f.write("\n".join([lines[0], *part]) + "\n")
        os.utime(f"{inbox}/part{i}.csv", (BASE + 1000 + i, BASE + 1000 + i))
    return inbox


def test_the_stream_job_sets_bad_clocks_aside_and_writes_its_counts(spark):
    mac = "02:00:00:00:00:77"
    line = f"{mac},ff:ff:ff:ff:ff:ff,1,{mac},10.0.0.9,00:00:00:00:00:00,10.0.0.1,"
    inbox = _inbox(spark, [f"{FAR},{line}", f"0,{line}", f",{line}", "broken,line,only"])
    out, plain = scratch_path(spark, "guard-out"), scratch_path(spark, "guard-plain")
    run_stream_job(spark, inbox, out, once=True, early=True)
    run_batch_job(spark, os.path.join(DATA, "story.csv"), plain)
    for name in ("spoof_reply_mismatch", "garp"):
        own = spark.read.parquet(f"{out}/detections/{name}")
        want = spark.read.parquet(f"{plain}/detections/{name}")
        assert set(rows_of(own.select(*want.columns))) <= set(rows_of(want))
    aside = archive.read_set_aside(spark, f"{out}/silver").collect()
    assert [r["frame.time_epoch"] for r in aside] == [FAR]
    counts = {(r.query, r["count"]): r.value for r in spark.read.parquet(f"{out}/counts").collect()}
    assert counts["ingest", "packets"] == 260 + 4 and counts["ingest", "set_aside"] == 1
    assert counts["ingest", "corrupt_lines"] == 1 and counts["ingest", "without_time"] == 2
    assert ("flood", "late_rows") in counts and counts["flood", "input_rows"] > 0
    # broken lines are kept as they were
    kept = spark.read.parquet(f"{out}/silver").where("_corrupt_record IS NOT NULL").collect()
    assert [r["_corrupt_record"] for r in kept] == ["broken,line,only"]
    early = spark.read.parquet(f"{out}/early/garp")
    assert early.count() > 0  # windows that the watermark has not closed yet


def test_a_clock_years_behind_or_ahead_costs_the_batch_profile_a_row_or_two(spark, packets):
    from lansight.operators import traffic

    rows = [pkt(0), pkt(BASE), pkt(BASE), pkt(BASE + 1), pkt(BASE + 86_400 * 3), pkt(253402300799), pkt(None)]
    runs = traffic.timeline_runs(packets(rows)).orderBy("sec").collect()
    assert [(r.sec, r.seconds, r.packets) for r in runs] == [
        (0, 1, 1), (1, BASE - 1, 0), (BASE, 1, 2), (BASE + 1, 1, 1), (BASE + 2, 86_400 * 3 - 2, 0),
        (BASE + 86_400 * 3, 1, 1), (BASE + 86_400 * 3 + 1, 253402300799 - BASE - 86_400 * 3 - 1, 0), (253402300799, 1, 1)]
    rate = traffic.packet_rate(packets(rows)).first()
    assert rate.span_seconds == 253402300800 and rate.packets == 6 and rate.idle_seconds == 253402300800 - 5
    part = traffic.traffic_timeline(packets(rows), BASE - 1, BASE + 2).orderBy("second").collect()
    assert [r.requests for r in part] == [0, 2, 1, 0]
    assert traffic.timeline_runs(packets([pkt(None)])).count() == 0
    assert traffic.packet_rate(packets([pkt(None)])).first().span_seconds == 0


def test_the_timeline_reads_its_packets_once(spark, packets):
    from lansight.operators import traffic
    from lansight.session import session_conf

    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = traffic.timeline_runs(packets([pkt(BASE + i) for i in range(9)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1


def _failing(path):
    """A sink that fails on its first micro-batch, once."""
    def write(rows, batch_id):
        if not os.path.exists(f"{path}/failed"):
            os.makedirs(f"{path}/failed")
            raise RuntimeError("first attempt")
        rows.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")
    return write


def test_a_failed_query_starts_again_while_others_go_on(spark):
    root = scratch_path(spark, "supervise")
    os.makedirs(root)
    csv.write_csv(capture(spark, 50), f"{root}/inbox")
    stream = csv.read_csv_stream(spark, f"{root}/inbox", max_files_per_trigger=0)
    counts = StreamCounts()
    spark.streams.addListener(counts)
    starters = {
        "steady": lambda: file_sink(stream, f"{root}/steady", f"{root}/c1", name="steady").trigger(availableNow=True).start(),
        "shaky": lambda: stream.writeStream.queryName("shaky").foreachBatch(_failing(root))
        .option("checkpointLocation", f"{root}/c2").trigger(availableNow=True).start(),
    }
    own = Supervisor(starters, counts, retries=2, pause=0.1).start()
    own.watch(60)
    counts.settle()
    spark.streams.removeListener(counts)
    assert own.restarts == {"shaky": 1} and not own.failed
    assert spark.read.parquet(f"{root}/out").count() == spark.read.parquet(f"{root}/steady").count() == 50
    assert counts.totals()["steady"]["input_rows"] == 50


def test_a_query_that_keeps_failing_is_given_up_and_reported(spark):
    root = scratch_path(spark, "give-up")
    os.makedirs(root)
    csv.write_csv(capture(spark, 5), f"{root}/inbox")
    stream = csv.read_csv_stream(spark, f"{root}/inbox", max_files_per_trigger=0)

    def broken(rows, batch_id):
        raise RuntimeError("always")

    counts = StreamCounts()
    spark.streams.addListener(counts)
    starters = {"broken": lambda: stream.writeStream.queryName("broken").foreachBatch(broken)
                .option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start()}
    own = Supervisor(starters, counts, retries=1, pause=0.1).start()
    with pytest.raises(RuntimeError, match="broken"):
        own.watch(60)
    spark.streams.removeListener(counts)
    assert own.restarts == {"broken": 1}


def test_early_results_show_open_windows_and_end_as_the_batch_answer(spark):
    raw = capture(spark)
    for rule, keys in ((rules.impersonation_rule(), ("window_start", "window_end", "mac")),
                       (rules.flood_rule(DEFAULT.with_(flood_requests=2)), ("second", "mac"))):
        want = rules.compile_batch(enrich(raw), rule)
        out, rp = replay(spark, raw, lambda s, r=rule: stream_rule_early(sc.packet_stream(s), r), f"early-{rule.name}",
                         slices=3, upsert_keys=keys)
        assert want.count() > 5 and rows_of(out.select(*want.columns)) == rows_of(want)
        first = spark.read.parquet(f"{rp.out}/batch_id=0")
        assert first.count() > 0  # long before the watermark closes them
        # a micro-batch that is run again replaces what it wrote
        upsert_batch(spark.createDataFrame(first.collect(), first.schema), 0, rp.out)
        assert rows_of(latest(spark, rp.out, keys).select(*want.columns).where(f"{keys[0]} < '2030-01-01'")) == rows_of(want)
        fold(spark, rp.out, keys, f"{rp.out}-folded")
        assert rows_of(latest(spark, f"{rp.out}-folded", keys)) == rows_of(latest(spark, rp.out, keys))


def test_early_sink_writes_what_changed(spark):
    root = scratch_path(spark, "early")
    for i in range(2):
        csv.write_csv(spark.createDataFrame([pkt(BASE + j, dst_ip=f"10.0.1.{10 * i + j}") for j in range(3)], RAW_SCHEMA),
                      f"{root}/inbox")
        packets = sc.packet_stream(csv.read_csv_stream(spark, f"{root}/inbox", max_files_per_trigger=0))
        rule = rules.flood_rule(DEFAULT.with_(flood_requests=1, flood_window=10))
        early_sink(stream_rule_early(packets, rule), f"{root}/out", f"{root}/c").trigger(availableNow=True).start() \
            .awaitTermination()
        assert [r.requests_per_sec for r in latest(spark, f"{root}/out", ("second", "mac")).collect()] == [3 * i + 3]


def test_flapping_on_the_stream_equals_batch(spark):
    raw = capture(spark, 1500)
    want = history.mac_flap(enrich(raw))
    out, _ = replay(spark, raw, lambda s: sc.stream_mac_flap(sc.packet_stream(s)), "flap", slices=4)
    assert want.count() > 2 and rows_of(out.select(*want.columns)) == rows_of(want)
    remaps = history.ip_mac_remap(enrich(raw))
    out, _ = replay(spark, raw, lambda s: sc.stream_ip_mac_remap(sc.packet_stream(s)), "remaps", slices=4)
    assert rows_of(out.select(*remaps.columns)) == rows_of(remaps)


def test_panes_on_the_stream_equal_batch(spark):
    raw = capture(spark)
    rule = rules.scanning_rule(DEFAULT.with_(scan_unique_targets=3))
    want = rules.compile_batch(enrich(raw), rule)
    out, _ = replay(spark, raw, lambda s: compile_panes(sc.packet_stream(s), rule), "panes", slices=3)
    assert want.count() > 5 and rows_of(out.select(*want.columns)) == rows_of(want)


def test_console_and_memory_sinks(spark):
    root = scratch_path(spark, "sinks")
    csv.write_csv(capture(spark, 60), f"{root}/inbox")
    packets = sc.packet_stream(csv.read_csv_stream(spark, f"{root}/inbox", max_files_per_trigger=0))
    q = console_sink(sc.stream_reply_mismatch(packets), "on_console").trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None and "Console" in str(q.lastProgress["sink"]) and q.lastProgress["numInputRows"] == 60
    counted = packets.groupBy("opcode").count()
    memory_sink(counted, "by_opcode", "complete").trigger(availableNow=True).start().awaitTermination()
    assert sum(r["count"] for r in spark.table("by_opcode").collect()) == 60


def test_the_rate_limit_takes_one_file_a_micro_batch(spark):
    root = scratch_path(spark, "rate")
    for i in range(3):
        csv.write_csv(capture(spark, 20, seed=i).coalesce(1), f"{root}/inbox")
    q = file_sink(csv.read_csv_stream(spark, f"{root}/inbox"), f"{root}/out", f"{root}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [p.numInputRows for p in q.recentProgress if p.numInputRows] == [20, 20, 20]
    shutil.rmtree(f"{root}/out", ignore_errors=True)
