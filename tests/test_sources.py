"""CSV / JSON / archive sources and the end-to-end capture story."""

from __future__ import annotations

import os

from lansight.functions.normalize import enrich
from lansight.operators import events, joins, rules
from lansight.schema import CORRUPT_COLUMN
from lansight.session import scratch_path
from lansight.sources import archive, csv, messages
from pyspark.sql import functions as F

DATA = os.path.join(os.path.dirname(__file__), "data")


def test_story_capture_end_to_end(spark):
    p = enrich(csv.read_csv_batch(spark, os.path.join(DATA, "story.csv")))
    scans = rules.detect_scanning(p).collect()
    assert {r.scanner_mac for r in scans} == {"62:5e:34:e9:d2:73"} and max(r.unique_targets for r in scans) == 253
    floods = rules.detect_flood(p).collect()
    assert {r.mac for r in floods} == {"62:5e:34:e9:d2:73"}
    forged = events.detect_spoofed_requests(p).collect()
    assert [(r.real_mac, r.claimed_mac, r.claimed_ip) for r in forged] == [
        ("62:5e:34:e9:d2:73", "44:fb:5a:d1:93:49", "192.168.1.1")]
    assert events.detect_reply_mismatch(p).count() == 0
    garps = rules.detect_garp(p).collect()
    assert [(r.mac, r.garp_count) for r in garps] == [("00:e0:4c:36:70:d5", 2)]
    # the two router replies to .9 are answers to nobody; the victim's reply answered the router
    unsol = sorted((r.mac, r.ip) for r in joins.detect_unsolicited(p).collect())
    assert unsol == [("44:fb:5a:d1:93:49", "192.168.1.1")] * 2


def test_dirty_rows_are_kept_with_nulls(spark):
    raw = csv.read_csv_batch(spark, os.path.join(DATA, "dirty.csv"), keep_corrupt=True)
    rows = raw.orderBy(F.col("`frame.time_epoch`").asc_nulls_first()).collect()
    assert len(rows) == 5
    assert sum(r[CORRUPT_COLUMN] is not None for r in rows) == 3  # bad number, bad opcode, short row
    p = enrich(csv.read_csv_batch(spark, os.path.join(DATA, "dirty.csv")))
    got = p.select("event_ts", "opcode", "eth_src", "is_gratuitous").collect()
    assert sum(r.event_ts is None for r in got) == 2
    assert {r.eth_src for r in got} == {"02:00:00:00:00:01"}
    assert [r.is_gratuitous for r in got if r.opcode == 2] == [True]


def test_eight_column_file_and_empty_file(spark):
    raw = csv.read_csv_batch(spark, os.path.join(DATA, "eight_columns.csv"))
    assert [r["arp.isgratuitous"] for r in raw.collect()] == [None, None]
    assert enrich(raw).filter("is_reply").count() == 1
    assert csv.read_csv_batch(spark, os.path.join(DATA, "empty")).count() == 0


def test_json_decode_bad_json_gives_nulls(spark):
    raw = csv.read_csv_batch(spark, os.path.join(DATA, "eight_columns.csv"))
    msgs = messages.encode_packets(raw).union(spark.createDataFrame([("{not json",)], "value string"))
    dec = messages.decode_packets(msgs).collect()
    assert len(dec) == 3 and sum(r["eth.src"] is None for r in dec) == 1


def test_archive_roundtrip_prunes_dates(spark):
    raw = csv.read_csv_batch(spark, os.path.join(DATA, "story.csv"))
    path = scratch_path(spark, "test-archive")
    archive.write_archive(raw, path)
    back = archive.read_archive(spark, path, dates=["2026-05-05"])
    assert back.count() == raw.count()
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date" in plan
    assert archive.read_archive(spark, path, dates=["2020-01-01"]).count() == 0


def test_trim_option_parses_spaced_numbers(spark):
    path = os.path.join(DATA, "spaced_numbers.csv")
    plain = enrich(csv.read_csv_batch(spark, path)).first()
    trimmed = enrich(csv.read_csv_batch(spark, path, trim=True)).first()
    # doubles tolerate the spaces, integers do not
    assert plain.epoch_ts == 1778013840.5 and plain.opcode is None
    assert trimmed.epoch_ts == 1778013840.5 and trimmed.opcode == 1
