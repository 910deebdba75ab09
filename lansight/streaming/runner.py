"""Running streaming detectors: file sinks with checkpoints, many named queries,
and a staged replay of a capture for tests and the driver contract.

``replay`` writes a capture into an inbox folder slice by slice (in time order)
and, after each slice, restarts the same query from its checkpoint with an
``availableNow`` trigger.  So state, watermark and sink log are carried over a
restart exactly as after a driver failure.  A final end-of-capture marker far
in the future (a request, a reply and a GARP from a reserved MAC) advances the
watermark so the last windows and unmatched replies are emitted; rows of the
marker itself never reach the results.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from lansight.config import DEFAULT, ArpConfig
from lansight.functions.timefn import clean_epoch_sql
from lansight.plans import report
from lansight.schema import RAW_SCHEMA
from lansight.session import scratch_path, session_conf
from lansight.sources import csv as csv_source
from lansight.streaming.early import early_sink, latest
from lansight.streaming.sinks import console_sink, file_sink, memory_sink  # noqa: F401  (re-exported)

# Reserved MAC / IP of the end-of-capture marker and how far after
# the last packet it is placed (seconds).
MARKER_MAC = "02:00:00:00:ff:ff"
MARKER_IP = "192.0.2.255"
MARKER_GAP_SECONDS = 86_400
#: A replay's packets per partition of state.
PARTITION_PACKETS = 200_000


def start_all(writers: dict[str, DataStreamWriter]) -> list[StreamingQuery]:
    """Start many named queries."""
    return [w.queryName(name).start() for name, w in writers.items()]


def await_and_stop(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until any query ends (or the timeout), then stop all."""
    try:
        spark.streams.awaitAnyTermination(timeout)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def time_slices(raw: DataFrame, n: int) -> list[DataFrame]:
    """Cut raw packets into ``n`` consecutive time ranges (rows without a time go first)."""
    sec = F.floor(F.expr(clean_epoch_sql("`frame.time_epoch`")))
    b = raw.agg(F.min(sec).alias("lo"), F.max(sec).alias("hi")).first()  # two numbers
    if b is None or b["lo"] is None:
        return [raw]
    lo, hi = int(b["lo"]), int(b["hi"])
    step = max(1, -(-(hi - lo + 1) // n))
    out = []
    for i in range(n):
        a, z = lo + i * step, lo + (i + 1) * step
        cond = (sec >= a) & (sec < z)
        if i == 0:
            cond = cond | sec.isNull()
        out.append(raw.filter(cond))
        if z > hi:
            break
    return out


def end_marker(spark: SparkSession, after_epoch: float) -> DataFrame:
    t = float(after_epoch + MARKER_GAP_SECONDS)
    rows = [
        (t, MARKER_MAC, "ff:ff:ff:ff:ff:ff", 1, MARKER_MAC, MARKER_IP, "00:00:00:00:00:00", MARKER_IP, None),
        (t, MARKER_MAC, MARKER_MAC, 2, MARKER_MAC, MARKER_IP, MARKER_MAC, MARKER_IP, None),
        (t, MARKER_MAC, "ff:ff:ff:ff:ff:ff", 2, MARKER_MAC, MARKER_IP, "ff:ff:ff:ff:ff:ff", MARKER_IP, "True"),
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def drop_marker(df: DataFrame, last_epoch: float) -> DataFrame:
    """Without the marker's own output: rows whose time lies beyond the last packet's, by a quarter of the
    marker's distance (windows start after it by less).  Addresses play no part; rows without a time stay."""
    limit = F.timestamp_seconds(F.lit(int(last_epoch) + MARKER_GAP_SECONDS // 4))
    cond = F.lit(True)
    for f in df.schema.fields:
        name = F.col(f"`{f.name}`")
        if f.dataType.simpleString() == "timestamp":
            cond = cond & F.coalesce(name < limit, F.lit(True))
        elif f.name == "frame.time_epoch":
            cond = cond & F.coalesce(name < F.lit(float(last_epoch + MARKER_GAP_SECONDS // 4)), F.lit(True))
    return df.filter(cond)


def state_partitions(spark: SparkSession, packets: int) -> int:
    """Partitions for a replay's state: enough for its packets and for every core, at most the session's.
    A partition of a stateful operator is loaded and committed in each micro-batch however little it holds,
    and adaptive execution doesn't join those of a stream."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(spark.sparkContext.defaultParallelism, -(-packets // PARTITION_PACKETS)))


@dataclass
class Replay:
    inbox: str
    out: str
    checkpoint: str
    batches: int


def replay(spark: SparkSession, raw: DataFrame, build: Callable[[DataFrame], DataFrame], name: str,
           slices: int = 4, cfg: ArpConfig = DEFAULT, partition_by: Sequence[str] = (),
           max_files_per_trigger: int = 0, first: DataFrame | None = None, arrival: bool = False,
           upsert_keys: Sequence[str] = ()) -> tuple[DataFrame, Replay]:
    """Replay ``raw`` as a CSV stream through ``build`` into a Parquet sink.

    Returns the sink read back (marker rows removed) and the folders used.  ``first``: packets that come
    with the first slice whatever their time; ``arrival``: the stream carries its files' times;
    ``upsert_keys``: early results in update mode, read back as the latest row of each key."""
    root = scratch_path(spark, f"stream-{name}")
    rp = Replay(f"{root}/inbox", f"{root}/out", f"{root}/checkpoint", 0)
    parts = time_slices(raw, slices)
    whole = raw.agg(F.max(F.expr(clean_epoch_sql("`frame.time_epoch`"))).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    hi = whole["hi"] or 0.0
    state = {"spark.sql.shuffle.partitions": str(state_partitions(spark, whole["n"]))}
    if first is not None:
        parts[0] = parts[0].unionByName(first)
    parts.append(end_marker(spark, hi))
    for part in parts:
        csv_source.write_csv(part, rp.inbox)
        stream = csv_source.read_csv_stream(spark, rp.inbox, cfg, max_files_per_trigger=max_files_per_trigger,
                                            arrival=arrival)
        if upsert_keys:
            writer = early_sink(build(stream), rp.out, rp.checkpoint)
        else:
            writer = file_sink(build(stream), rp.out, rp.checkpoint, partition_by=partition_by)
        with session_conf(spark, state):  # the checkpoint keeps the first run's number
            q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream {name} failed: {q.exception()}")
        rp.batches += 1
    back = latest(spark, rp.out, upsert_keys) if upsert_keys else spark.read.parquet(rp.out)
    return drop_marker(back, hi), rp


def microbatch_alerts(spark: SparkSession, raw_stream: DataFrame, out: str, checkpoint: str,
                      cfg: ArpConfig = DEFAULT) -> StreamingQuery:
    """W3 (compatibility): run the *batch* detectors on each micro-batch alone,
    as the per-micro-batch design does.  Windows and the interval join then see
    one micro-batch only, so results differ from the stateful detectors.
    Each batch's alerts are written to ``out/batch_id=N`` with overwrite, so a
    replayed batch replaces its own output (idempotent)."""
    from lansight.functions.normalize import enrich
    from lansight.plans.batch import detections

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        packets = enrich(batch_df, cfg)
        alerts = report.alerts_unified(detections(packets, cfg))
        alerts.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (raw_stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
