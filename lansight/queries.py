"""Driver contract: one Spark query per operator key, over the test tables.

Every query starts from the ``events`` table of an sf folder, derives the raw
packet table from it (``sources.events_adapter``), normalises it and runs one
operator.  Results pass through ``at_boundary`` so timestamps compare equal to
the DuckDB oracle whatever the session time zone is.  Queries that exercise a
file source or sink write their staging files under the shared checkpoint
folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lansight.config import DEFAULT
from lansight.functions.normalize import enrich, gratuitous_flag, raw
from lansight.operators import events, features, history, inventory, joins, rules, traffic
from lansight.operators.panes import compile_panes
from lansight.operators.talkers import window_top_talkers
from lansight.oracle import MICROBATCHES
from lansight.plans import batch, onepass, report, sql, sql_functions
from lansight.schema import ENRICHED_COLUMNS
from lansight.session import at_boundary, scratch_path
from lansight.sources import archive, csv, messages
from lansight.sources.events_adapter import raw_packets
from lansight.streaming.compile import (packet_stream, stream_alerts, stream_ip_mac_remap, stream_mac_flap,
                                        stream_reply_mismatch, stream_rule, stream_unsolicited)
from lansight.streaming.early import stream_rule_early
from lansight.streaming.runner import microbatch_alerts, replay, time_slices

QueryFn = Callable[[SparkSession, str], DataFrame]


def packets(spark: SparkSession, sf_dir: str, cfg=DEFAULT) -> DataFrame:
    return enrich(raw_packets(spark, sf_dir), cfg)


def _on_packets(op) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return at_boundary(op(packets(spark, sf_dir)))
    return run


def _on_alerts(op) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return at_boundary(op(onepass.alerts(packets(spark, sf_dir))))
    return run


def _on_counts(op) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return at_boundary(op(onepass.counts(packets(spark, sf_dir))))
    return run


def _on_detections(op) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return at_boundary(op(batch.run_batch(packets(spark, sf_dir)).detections))
    return run


# --- sources ----------------------------------------------------------------

def q_src_csv_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv-batch")
    csv.write_csv(raw_packets(spark, sf_dir), path)
    return csv.read_csv_batch(spark, path)


def q_src_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture lines with broken fields are kept, broken fields become null and
    the line is flagged.  Lines are rendered from the packets; every 13th packet
    gets an unparsable time, every 17th loses its last three fields."""
    from lansight.schema import CORRUPT_COLUMN, RAW_COLUMNS
    from lansight.sources.events_adapter import packets_from_events, read_events

    r = packets_from_events(read_events(spark, sf_dir), keep_id=True)
    eid = F.col("event_id")
    fields = [F.coalesce(raw(n).cast("string"), F.lit("")) for n in RAW_COLUMNS]
    bad_time = F.concat(F.lit("x"), fields[0])
    line = (F.when(eid % 13 == 0, F.concat_ws(",", bad_time, *fields[1:]))
            .when(eid % 17 == 0, F.concat_ws(",", *fields[:6]))
            .otherwise(F.concat_ws(",", *fields)))
    path = scratch_path(spark, "malformed")
    r.select(line.alias("value")).write.text(path)
    back = csv.read_csv_batch(spark, path, keep_corrupt=True, header=False)
    return back.select(*[raw(n) for n in RAW_COLUMNS], F.col(CORRUPT_COLUMN).isNotNull().alias("is_corrupt"))


def q_src_json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.decode_packets(messages.encode_packets(raw_packets(spark, sf_dir)))


def q_archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    archive.write_archive(raw_packets(spark, sf_dir), path)
    return at_boundary(enrich(archive.read_archive(spark, path)))


def q_normalize_gratuitous(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw_packets(spark, sf_dir)
    return r.select(raw("frame.time_epoch").alias("epoch_ts"), raw("arp.isgratuitous").alias("gratuitous_raw"),
                    gratuitous_flag(raw("arp.isgratuitous")).alias("is_gratuitous"))


def q_archive_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of many small files, compacted by date."""
    path = scratch_path(spark, "archive-compacted")
    archive.write_archive(raw_packets(spark, sf_dir).repartition(12), path)
    archive.compact_archive(spark, path)
    return at_boundary(enrich(archive.read_archive(spark, path)))


def _sql_function(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql_functions.register_functions(packets(spark, sf_dir))
        return at_boundary(sql_functions.call(spark, name))
    return run


def q_sql_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_boundary(sql.sql_conflict(packets(spark, sf_dir)))


def q_mac_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_boundary(features.mac_outliers(packets(spark, sf_dir)))


QUERIES: dict[str, QueryFn] = {
    # sources and normalisation
    "src_csv_batch": q_src_csv_batch,
    "src_json_decode": q_src_json_decode,
    "src_malformed": q_src_malformed,
    "archive_roundtrip": q_archive_roundtrip,
    "archive_compacted": q_archive_compacted,
    "normalize_packets": _on_packets(lambda p: p),
    "normalize_event_time": _on_packets(lambda p: p.select("epoch_ts", "event_ts")),
    "normalize_gratuitous": q_normalize_gratuitous,
    "packet_flags": _on_packets(lambda p: p.select("epoch_ts", "is_broadcast", "is_request", "is_reply",
                                                   "has_mac_mismatch")),
    # the nine detectors
    "scanning": _on_packets(rules.detect_scanning),
    "garp": _on_packets(rules.detect_garp),
    "flood": _on_packets(rules.detect_flood),
    "impersonation": _on_packets(rules.detect_impersonation),
    "conflict": _on_packets(rules.detect_conflicts),
    "spoof_mac_flipping": _on_packets(rules.detect_mac_flipping),
    "spoof_ip_flipping": _on_packets(rules.detect_ip_flipping),
    "spoof_reply_mismatch": _on_packets(events.detect_reply_mismatch),
    "unsolicited": _on_packets(joins.detect_unsolicited),
    "unsolicited_asof": _on_packets(lambda p: joins.detect_unsolicited(p, method="asof")),
    "unsolicited_covered": _on_packets(lambda p: joins.detect_unsolicited(p, method="covered")),
    "request_reply_match": _on_packets(joins.request_reply_match),
    # aggregate primitives alone, no threshold
    "window_tumbling_counts": _on_packets(rules.window_tumbling_counts),
    "window_sliding_counts": _on_packets(rules.window_sliding_counts),
    "window_distinct_targets": _on_packets(rules.window_distinct_targets),
    "window_identity_pairs": _on_packets(rules.window_identity_pairs),
    "window_first_last": _on_packets(rules.window_first_last),
    # traffic profile
    "traffic_timeline": _on_packets(traffic.traffic_timeline),
    "top_talkers": _on_packets(traffic.top_talkers),
    "window_top_talkers": _on_packets(lambda p: window_top_talkers(p, k=3)),
    "opcode_counts": _on_packets(traffic.opcode_counts),
    "opcode_distribution": _on_packets(traffic.opcode_distribution),
    "packet_totals": _on_packets(traffic.packet_totals),
    "packet_rate": _on_packets(traffic.packet_rate),
    "timeline_runs": _on_packets(traffic.timeline_table),
    "top_requesters": _on_packets(traffic.top_requesters),
    # reports over all detectors
    "alerts_unified": _on_alerts(lambda a: a),
    "detection_summary": _on_counts(report.summary_of),
    "detection_status": _on_counts(report.status_of),
    "threat_score": _on_counts(report.score_of),
    "spoofing_summary": _on_detections(report.spoofing_summary),
    "alerts_json": _on_alerts(report.alerts_json),
    # rules described in the reference's documents
    "spoofed_requests": _on_packets(events.detect_spoofed_requests),
    "garp_storm": _on_packets(rules.detect_garp_storm),
    "unsolicited_by_mac": _on_packets(joins.detect_unsolicited_by_mac),
    "ip_mac_remap": _on_packets(history.ip_mac_remap),
    "mac_flap": _on_packets(history.mac_flap),
    "mac_inventory": _on_packets(inventory.mac_inventory),
    "ip_inventory": _on_packets(inventory.ip_inventory),
    "mac_features": _on_packets(features.mac_features),
    "mac_outliers": q_mac_outliers,
    "scanning_approx": _on_packets(lambda p: compile_panes(p, rules.scanning_rule(DEFAULT))),
    "sql_conflict": q_sql_conflict,
    **{f"sql_function_{n}": _sql_function(n) for n in ("scanning", "flood", "garp", "conflict", "mac_flipping")},
}


# --- streaming ----------------------------------------------------------------

def _stream_query(name: str, build, slices: int = 4) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out, _ = replay(spark, raw_packets(spark, sf_dir), build, name, slices=slices)
        return at_boundary(out)
    return run


def _stream_rule(rule_fn) -> QueryFn:
    return _stream_query(rule_fn(DEFAULT).name, lambda s: stream_rule(packet_stream(s), rule_fn(DEFAULT)))


def q_src_csv_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = replay(spark, raw_packets(spark, sf_dir), lambda s: s, "csv-stream")
    return at_boundary(enrich(out))


def q_sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the normalised packet stream into a date-partitioned Parquet sink."""
    def build(s):
        p = enrich(s)
        return p.withColumn("date", F.date_from_unix_date(
            F.floor(F.unix_seconds(F.col("event_ts")) / 86400).cast("int")).cast("string"))
    out, _rp = replay(spark, raw_packets(spark, sf_dir), build, "sink-parquet", partition_by=("date",))
    return at_boundary(out.select(*ENRICHED_COLUMNS))


def q_stream_microbatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contiguous time ranges, each one micro-batch of as many files as its packets need."""
    root = scratch_path(spark, "stream-microbatch")
    for part in time_slices(raw_packets(spark, sf_dir), MICROBATCHES):
        csv.write_csv(part, f"{root}/inbox")
        q = microbatch_alerts(spark, csv.read_csv_stream(spark, f"{root}/inbox", DEFAULT, max_files_per_trigger=0),
                              f"{root}/out", f"{root}/checkpoint")
        q.awaitTermination()
    return at_boundary(spark.read.parquet(f"{root}/out"))


def q_stream_scanning_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capture with one packet dated 2099 in its first slice; the others' answer stays."""
    whole = raw_packets(spark, sf_dir)
    ahead = whole.where(raw("frame.time_epoch").isNotNull()).orderBy(raw("frame.time_epoch")).limit(1) \
        .withColumn("frame.time_epoch", F.lit(4_070_908_800.0))
    rule = rules.scanning_rule(DEFAULT)
    out, _ = replay(spark, whole, lambda s: stream_rule(packet_stream(s), rule), "scanning-guarded", first=ahead,
                    arrival=True)
    return at_boundary(out)


def _stream_early(rule_fn, keys) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rule = rule_fn(DEFAULT)
        out, _ = replay(spark, raw_packets(spark, sf_dir), lambda s: stream_rule_early(packet_stream(s), rule),
                        f"{rule.name}-early", upsert_keys=keys)
        return at_boundary(out)
    return run


def _register_streaming() -> None:
    QUERIES.update({
        "src_csv_stream": q_src_csv_stream,
        "sink_parquet_roundtrip": q_sink_parquet_roundtrip,
        "stream_scanning": _stream_rule(rules.scanning_rule),
        "stream_garp": _stream_rule(rules.garp_rule),
        "stream_flood": _stream_rule(rules.flood_rule),
        "stream_mac_flipping": _stream_rule(rules.mac_flipping_rule),
        "stream_ip_flipping": _stream_rule(rules.ip_flipping_rule),
        "stream_impersonation": _stream_rule(rules.impersonation_rule),
        "stream_conflict": _stream_rule(rules.conflict_rule),
        "stream_reply_mismatch": _stream_query("reply-mismatch", lambda s: stream_reply_mismatch(packet_stream(s))),
        "stream_unsolicited": _stream_query("unsolicited", lambda s: stream_unsolicited(packet_stream(s))),
        "stream_microbatch": q_stream_microbatch,
        "stream_alerts": _stream_query("alerts", lambda s: stream_alerts(packet_stream(s)), slices=2),
        "stream_mac_flap": _stream_query("mac-flap", lambda s: stream_mac_flap(packet_stream(s))),
        "stream_scanning_approx": _stream_query(
            "scanning-approx", lambda s: compile_panes(packet_stream(s), rules.scanning_rule(DEFAULT))),
        "stream_top_talkers": _stream_query("top-talkers", lambda s: window_top_talkers(packet_stream(s), k=3)),
        "stream_scanning_guarded": q_stream_scanning_guarded,
        "stream_scanning_early": _stream_early(rules.scanning_rule, ("window_start", "window_end", "scanner_mac")),
        "stream_flood_early": _stream_early(rules.flood_rule, ("second", "mac")),
        "stream_ip_mac_remap": _stream_query("ip-mac-remap", lambda s: stream_ip_mac_remap(packet_stream(s))),
    })


_register_streaming()
