from __future__ import annotations

import os

from lansight.job import run_batch_job
from lansight.session import scratch_path

DATA = os.path.join(os.path.dirname(__file__), "data")


def test_batch_job_writes_everything(spark):
    out = scratch_path(spark, "test-job")
    run_batch_job(spark, os.path.join(DATA, "story.csv"), out)
    summary = {r.detector: r.detections for r in spark.read.parquet(f"{out}/summary").collect()}
    assert summary["scanning"] > 0 and summary["flood"] == 1 and summary["unsolicited"] == 2
    t = spark.read.parquet(f"{out}/threat").first()
    assert t.threat_level in ("LOW", "ELEVATED", "CRITICAL")
    assert spark.read.parquet(f"{out}/alerts").count() == sum(summary.values())
    assert spark.read.parquet(f"{out}/archive").count() == 260


def test_stream_job_once_matches_batch(spark):
    import shutil
    import tempfile

    from lansight.functions.normalize import enrich
    from lansight.job import run_stream_job
    from lansight.operators import rules
    from lansight.sources import csv

    inbox = tempfile.mkdtemp(prefix="lansight-inbox-")
    shutil.copy(os.path.join(DATA, "story.csv"), inbox)
    out = scratch_path(spark, "test-stream-job")
    run_stream_job(spark, inbox, out, once=True)
    # the one capture file is all there is: windows still open stay in state, so
    # compare the stateless detector and check the rule sinks exist
    mismatch = spark.read.parquet(f"{out}/detections/spoof_reply_mismatch")
    assert mismatch.count() == 0
    assert spark.read.parquet(f"{out}/silver").count() == 260
    scans = spark.read.parquet(f"{out}/detections/scanning")
    batch = rules.detect_scanning(enrich(csv.read_csv_batch(spark, inbox)))
    assert scans.count() <= batch.count()


def test_batch_job_family_from_written_level1_equals_direct(spark):
    import random

    from conftest import BASE, pkt

    from lansight.functions.normalize import enrich
    from lansight.operators import rules
    from lansight.schema import RAW_SCHEMA
    from lansight.sources import csv

    rng = random.Random(4)
    rows = [pkt(BASE + rng.random() * 120, eth_src=f"02:00:00:00:00:0{rng.randrange(3)}", opcode=rng.choice([1, 2]),
                src_mac=rng.choice(["02:00:00:00:00:0a", "02:00:00:00:00:0b"]),
                src_ip=rng.choice(["10.0.0.1", "10.0.0.2", "0.0.0.0"]), garp=rng.choice([None, "True"]))
            for _ in range(300)]
    inbox = scratch_path(spark, "test-job-family-in")
    csv.write_csv(spark.createDataFrame(rows, RAW_SCHEMA), inbox)
    out = scratch_path(spark, "test-job-family")
    run_batch_job(spark, inbox, out)
    direct = rules.detect_identity_family(enrich(csv.read_csv_batch(spark, inbox)))
    for name, df in direct.items():
        got = spark.read.parquet(f"{out}/detections/{name}")
        assert df.count() > 0
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect())), name
