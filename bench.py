"""Benchmark the headline queries and print ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (timed runs per query, default 3; the median is reported),
     BENCH_COPIES (default 1: >1 replays the capture that many times back to back
                   in time, a longer capture with the same traffic pattern),
     BENCH_QUERIES (comma list to run a subset).

Each query is executed in full on the executors with the ``noop`` sink (no
collect to the driver).  The first run of each query is a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "scanning", "garp", "flood", "impersonation", "conflict", "spoof_reply_mismatch",
    "spoof_mac_flipping", "spoof_ip_flipping", "unsolicited", "alerts_unified", "threat_score",
    "traffic_timeline", "top_talkers", "packet_totals", "ip_mac_remap", "mac_features", "request_reply_match",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    copies = int(os.environ.get("BENCH_COPIES", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from pyspark.sql import functions as F

    from lansight import queries as Q
    from lansight.functions.normalize import enrich
    from lansight.session import build_session
    from lansight.sources import events_adapter

    extra = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="lansight-bench-")
    parts = int(os.environ.get("BENCH_PARTITIONS", str(max(4, cpus * 2))))
    spark = build_session("lansight-bench", master=f"local[{cpus}]", partitions=parts, extra=extra)

    if copies > 1:
        # a longer capture: copy c of every event is shifted by c * (number of events) ids,
        # i.e. c * span seconds later in packet time
        ev = events_adapter.read_events(spark, sf_dir)
        n = ev.count()
        ev = ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))) \
            .withColumn("event_id", F.col("event_id") + F.col("copy") * F.lit(n)).drop("copy")
        packets = enrich(events_adapter.packets_from_events(ev))
        Q.packets = lambda spark_, sf_dir_, cfg=None: packets
        n_packets = n * copies
    else:
        n_packets = spark.read.parquet(events_adapter.events_path(sf_dir)).count()

    names = only or [q for q in HEADLINE if q in Q.QUERIES]
    times: dict[str, float] = {}
    for name in names:
        fn = Q.QUERIES[name]
        runs = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 4)
    total = round(sum(times.values()), 4)
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "packets": n_packets,
        "copies": copies,
        "packets_per_sec_all_queries": round(n_packets * len(times) / total, 1) if total else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
