"""Skew experiment: the same operators on a capture with and without a hot key.

The capture is the events-derived packet table replayed COPIES times back to
back in time.  In the skewed variant the first third of the copies is rewritten
into one flood: a single MAC and a single IP pair, squeezed into HOT_SECONDS,
alternating requests and replies.  Prints one JSON line per variant with the
wall time of each operator (full execution into the noop sink).

usage: python tools/skew_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from lansight.functions.normalize import enrich  # noqa: E402
from lansight.operators import history, joins, rules, traffic  # noqa: E402
from lansight.session import build_session  # noqa: E402
from lansight.sources import events_adapter  # noqa: E402

HOT_SECONDS = 100


def capture(spark, sf_dir: str, copies: int, skew: bool):
    ev = events_adapter.read_events(spark, sf_dir)
    n = ev.count()
    ev = ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    ev = ev.withColumn("event_id", F.col("event_id") + F.col("copy") * F.lit(n))
    raw = events_adapter.packets_from_events(ev.drop("copy").withColumn("copy", F.floor(F.col("event_id") / n)))
    if not skew:
        return enrich(raw)
    hot = F.floor((F.col("`frame.time_epoch`") - F.lit(float(events_adapter.BASE_EPOCH))) * 64 / n) < copies // 3
    idx = (F.col("`frame.time_epoch`") - F.lit(float(events_adapter.BASE_EPOCH))) * 64
    is_rep = (F.floor(idx) % 2) == 1
    hot_cols = {
        "frame.time_epoch": F.lit(float(events_adapter.BASE_EPOCH)) + idx * F.lit(HOT_SECONDS) / F.lit(float(n * (copies // 3))),
        "eth.src": F.lit("02:00:00:00:00:77"),
        "eth.dst": F.when(is_rep, F.lit("02:00:00:00:00:78")).otherwise(F.lit("ff:ff:ff:ff:ff:ff")),
        "arp.opcode": F.when(is_rep, F.lit(2)).otherwise(F.lit(1)),
        "arp.src.hw_mac": F.lit("02:00:00:00:00:77"),
        "arp.src.proto_ipv4": F.when(is_rep, F.lit("10.9.9.2")).otherwise(F.lit("10.9.9.1")),
        "arp.dst.hw_mac": F.lit("00:00:00:00:00:00"),
        "arp.dst.proto_ipv4": F.when(is_rep, F.lit("10.9.9.1")).otherwise(F.lit("10.9.9.2")),
        "arp.isgratuitous": F.lit(None).cast("string"),
    }
    cols = [F.when(hot, v).otherwise(F.col(f"`{k}`")).alias(k) for k, v in hot_cols.items()]
    return enrich(raw.select(*cols))


OPS = {
    "flood": rules.detect_flood,
    "scanning": rules.detect_scanning,
    "impersonation": rules.detect_impersonation,
    "unsolicited": joins.detect_unsolicited,
    "request_reply_match": joins.request_reply_match,
    "ip_mac_remap": history.ip_mac_remap,
    "top_talkers": traffic.top_talkers,
    "traffic_timeline": traffic.traffic_timeline,
}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    spark = build_session("skew-check", master="local[8]", partitions=16,
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="skew-")})
    for skew in (False, True):
        p = capture(spark, sf_dir, copies, skew).persist()
        rows = p.count()
        hot = p.filter(F.col("eth_src") == "02:00:00:00:00:77").count()
        times = {}
        for name, op in OPS.items():
            op(p).write.format("noop").mode("overwrite").save()  # warm
            t0 = time.perf_counter()
            op(p).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 2)
        print(json.dumps({"skew": skew, "packets": rows, "hot_share": round(hot / rows, 3), "sec": times}))
        p.unpersist()
    spark.stop()


if __name__ == "__main__":
    main()
