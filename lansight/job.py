"""spark-submit entry point.

batch:  CSV folder -> Parquet archive (date-partitioned) -> every detection, the
        alert table, the per-detector summary, the threat score, the traffic profile
        and the lines that did not parse, as Parquet.
stream: CSV folder (or Kafka) as a stream -> one stateful query per detector, one for
        IP-MAC remaps and one for flapping, each with its own Parquet sink, until stopped.
        Checkpoints belong to the output: they lie in its ``_checkpoints`` folder.
compact: an archive's small files -> few files per date, sorted by sender.

    spark-submit lansight/job.py --mode batch --input s3://.../captures --output s3://.../arp
"""

from __future__ import annotations

import argparse
import os
import sys
import time
import uuid

from pyspark.sql import functions as F

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lansight.config import DEFAULT, ArpConfig  # noqa: E402
from lansight.functions.normalize import enrich  # noqa: E402
from lansight.operators import rules  # noqa: E402
from lansight.operators.windows import family_finish, family_level1  # noqa: E402
from lansight.plans import report  # noqa: E402
from lansight.plans.batch import run_batch  # noqa: E402
from lansight.operators import traffic  # noqa: E402
from lansight.session import build_session  # noqa: E402
from lansight.schema import CORRUPT_COLUMN  # noqa: E402
from lansight.sources import archive, csv, messages  # noqa: E402
from lansight.streaming import compile as sc  # noqa: E402
from lansight.streaming.clock_guard import mark_aside  # noqa: E402
from lansight.streaming.early import early_sink, stream_rule_early  # noqa: E402
from lansight.streaming.sinks import console_sink, file_sink  # noqa: E402
from lansight.streaming.supervise import StreamCounts, Supervisor  # noqa: E402


def run_batch_job(spark, inp: str, out: str, cfg: ArpConfig = DEFAULT, from_archive: bool = False) -> None:
    silver = inp if from_archive else f"{out}/archive"
    if not from_archive:
        archive.write_archive(csv.read_csv_batch(spark, inp, keep_corrupt=True), silver, mode="overwrite")
    archive.read_corrupt(spark, silver).write.mode("overwrite").parquet(f"{out}/corrupt")
    packets = enrich(archive.read_archive(spark, silver), cfg)
    detections = run_batch(packets, cfg).detections
    # the three identity rules share one level-1 aggregate: write it once (small,
    # pre-aggregated) and finish the three detections from the written table
    fam = rules.identity_rules(cfg)
    family_level1(packets, fam).write.mode("overwrite").parquet(f"{out}/_stage/identity_level1")
    detections.update(family_finish(spark.read.parquet(f"{out}/_stage/identity_level1"), fam))
    for name, df in detections.items():
        df.write.mode("overwrite").parquet(f"{out}/detections/{name}")
    # the alert table is rebuilt from the written detections, so no rule runs twice
    written = {n: spark.read.parquet(f"{out}/detections/{n}") for n, _ in report.DETECTORS}
    table = report.alerts_unified(written)
    table.write.mode("overwrite").parquet(f"{out}/alerts")
    alerts = spark.read.parquet(f"{out}/alerts")
    report.detection_status(alerts).write.mode("overwrite").parquet(f"{out}/summary")
    report.threat_score(alerts, cfg).write.mode("overwrite").parquet(f"{out}/threat")
    for name, df in traffic.profile(packets).items():
        df.write.mode("overwrite").parquet(f"{out}/profile/{name}")


def run_stream_job(spark, inp: str, out: str, cfg: ArpConfig = DEFAULT, kafka: bool = False,
                   timeout: float | None = None, once: bool = False, early: bool = False, show: bool = False) -> list:
    """Ingest the source once into a date-partitioned Parquet stream ("silver"),
    then run every detector as its own stateful query over the silver stream,
    each with its own checkpoint in the output's ``_checkpoints`` folder: another
    output starts afresh, the same output goes on where it stopped.

    Packets dated after what their arrival allows are set aside at ingest, where they can't move the
    detectors' watermarks.  A query that fails starts again from its checkpoint, ``stream_retries`` times
    at most, while the others go on.  ``counts`` gets a run's numbers per query: packets, set-aside ones,
    broken lines, rows behind the watermark.

    ``once``: process what is there (``availableNow``) and return, for batch-like scheduled runs; state and
    offsets carry over to the next run.  ``early``: window rules also report unfinished windows (update
    mode) under ``early``.  ``show``: detections are printed as they come (console sink)."""
    raw = messages.read_kafka_stream(spark, cfg, arrival=True).withColumn(CORRUPT_COLUMN, F.lit(None).cast("string")) \
        if kafka else csv.read_csv_stream(spark, inp, cfg, keep_corrupt=True, arrival=True)
    ckpt, silver = f"{out}/_checkpoints", f"{out}/silver"
    counts = StreamCounts()
    spark.streams.addListener(counts)

    def starter(writer):
        return lambda: (writer.trigger(availableNow=True) if once else writer).start()

    rows = mark_aside(raw, cfg).withColumn("date", archive.capture_date(raw))
    ingest = Supervisor({"ingest": starter(file_sink(rows, silver, f"{ckpt}/ingest", name="ingest",
                                                     partition_by=("aside", "date")))}, counts, cfg.stream_retries).start()
    q_ingest = ingest.queries["ingest"]
    try:
        if once:
            ingest.watch()
        else:
            while q_ingest.isActive and q_ingest.lastProgress is None:
                time.sleep(0.2)
        packets = sc.packet_stream(archive.read_silver_stream(spark, silver), cfg)
        outputs = {r.name: sc.stream_rule(packets, r) for r in rules.standard_rules(cfg)}
        outputs["spoof_reply_mismatch"] = sc.stream_reply_mismatch(packets, cfg)
        outputs["unsolicited"] = sc.stream_unsolicited(packets, cfg)
        outputs["ip_mac_remap"] = sc.stream_ip_mac_remap(packets, cfg)
        outputs["mac_flap"] = sc.stream_mac_flap(packets, cfg)
        starters = {name: starter(file_sink(df, f"{out}/detections/{name}", f"{ckpt}/{name}", name=name))
                    for name, df in outputs.items()}
        if early:
            for r in rules.standard_rules(cfg):
                starters[f"early_{r.name}"] = starter(early_sink(
                    stream_rule_early(packets, r), f"{out}/early/{r.name}", f"{ckpt}/early_{r.name}", name=f"early_{r.name}"))
        if show:
            for name, df in outputs.items():
                starters[f"show_{name}"] = starter(console_sink(df, f"show_{name}"))
        # the ingest joins the others under one supervision, without being started twice
        every = Supervisor(starters if once else {"ingest": ingest.starters["ingest"], **starters}, counts, cfg.stream_retries)
        if not once:
            every.queries["ingest"] = q_ingest
        every.start().watch(timeout)
    finally:
        counts.settle()
        spark.streams.removeListener(counts)
        counts.frame(spark).withColumn("run", F.lit(uuid.uuid4().hex)).write.mode("append").parquet(f"{out}/counts")
    return list(every.queries.values())


def config_from(settings: list[str], base: ArpConfig = DEFAULT) -> ArpConfig:
    """``base`` with NAME=VALUE settings, each read as its field's type."""
    changes: dict = {}
    weights = dict(base.threat_weights)
    for setting in settings:
        name, eq, value = setting.partition("=")
        if name.startswith("threat_weights."):
            weight = name.removeprefix("threat_weights.")
            if weight not in weights or not eq:
                raise ValueError(f"no such weight: {setting!r}")
            weights[weight] = int(value)
            changes["threat_weights"] = weights
            continue
        if name not in base.__dataclass_fields__ or name == "threat_weights" or not eq:
            raise ValueError(f"no such setting: {setting!r}")
        kind = type(getattr(base, name))
        changes[name] = value.lower() in ("1", "true", "yes") if kind is bool else kind(value)
    return base.with_(**changes)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="ARP anomaly detection on Spark")
    ap.add_argument("--mode", choices=("batch", "stream", "compact"), default="batch")
    ap.add_argument("--input", required=False, help="CSV capture folder (or archive with --from-archive)")
    ap.add_argument("--output", required=True)
    ap.add_argument("--from-archive", action="store_true")
    ap.add_argument("--kafka", action="store_true")
    ap.add_argument("--timeout", type=float, default=None)
    ap.add_argument("--once", action="store_true", help="stream mode: process what is there and stop")
    ap.add_argument("--master", default=None)
    ap.add_argument("--early", action="store_true", help="stream mode: report unfinished windows too")
    ap.add_argument("--show", action="store_true",
                    help="batch mode: print the totals, the 9-row summary and the score; stream mode: print detections")
    ap.add_argument("--set", action="append", default=[], metavar="NAME=VALUE",
                    help="a field of the configuration, such as flood_requests=80 or max_files_per_trigger=20; "
                         "threat_weights.NAME=VALUE for a weight")
    a = ap.parse_args(argv)
    cfg = config_from(a.set)
    spark = build_session("lansight-job", master=a.master)
    if a.mode == "batch":
        run_batch_job(spark, a.input, a.output, cfg, from_archive=a.from_archive)
        if a.show:  # K4: the totals, nine summary rows and one score row are all that reach the driver
            spark.read.parquet(f"{a.output}/profile/totals").show(truncate=False)
            spark.read.parquet(f"{a.output}/summary").show(truncate=False)
            spark.read.parquet(f"{a.output}/threat").show(truncate=False)
    elif a.mode == "compact":
        print("rewritten:", ", ".join(archive.compact_archive(spark, a.output)) or "nothing")
    else:
        run_stream_job(spark, a.input, a.output, cfg, kafka=a.kafka, timeout=a.timeout, once=a.once, early=a.early,
                       show=a.show)


if __name__ == "__main__":
    main()
