"""The stream's reply check: what a reply probes doesn't grow with the time range of a micro-batch."""

from __future__ import annotations

import pytest
from conftest import BASE, pkt

from lansight.config import DEFAULT
from lansight.functions.normalize import enrich
from lansight.operators import joins
from lansight.schema import RAW_SCHEMA
from lansight.streaming import compile as sc
from lansight.streaming.runner import replay

MICROS = DEFAULT.with_(time_precision="micros")


def _capture():
    """One busy pair over ten minutes, replies at the look-back's edges around the borders of buckets."""
    rows = []
    for i in range(150):
        t = BASE + 4 * i
        if i % 3 == 0:
            rows += [pkt(t, src_ip="10.0.0.1", dst_ip="10.0.0.2")] * 2
        rows.append(pkt(t + i % 7, opcode=2, src_ip="10.0.0.2", dst_ip="10.0.0.1"))
        rows.append(pkt(t + i % 7 + i % 4 / 4, opcode=2, src_ip="10.0.0.2", dst_ip="10.0.0.1", src_mac=None))
        rows.append(pkt(t, opcode=2, src_ip="10.0.0.1", dst_ip="10.0.0.2"))  # the reversed pair
    return rows


@pytest.mark.parametrize("cfg", [DEFAULT, MICROS, DEFAULT.with_(unsolicited_lookback=0),
                                 DEFAULT.with_(unsolicited_lookback=58)])
def test_replies_at_the_borders_of_buckets(spark, cfg):
    raw = spark.createDataFrame(_capture(), RAW_SCHEMA)
    got, _ = replay(spark, raw, lambda s: sc.stream_unsolicited(sc.packet_stream(s, cfg), cfg), "borders", slices=2)
    want = joins.detect_unsolicited(enrich(raw, cfg), cfg)
    order = lambda df: sorted(map(str, df.collect()))
    assert order(got.select(*want.columns)) == order(want) and want.count() > 100


@pytest.mark.parametrize("build", [sc.stream_unsolicited, sc.stream_alerts,
                                   lambda p: sc.stream_unsolicited(p, MICROS)])
def test_no_reply_meets_all_requests_of_its_pair(spark, tmp_path, build):
    from lansight.sources import csv

    stream = csv.read_csv_stream(spark, str(tmp_path))
    plan = build(sc.packet_stream(stream))._jdf.queryExecution().analyzed().toString()
    assert all("req_bucket" in line for line in plan.splitlines() if "Join LeftOuter" in line)
