"""Early results of window rules: update mode and an idempotent keyed upsert.

In update mode a window is reported with every micro-batch that changes it, long before the watermark
closes it.  A file sink can't take that, so the rows go through ``foreachBatch``: a micro-batch writes
its changed rows as the partition ``batch_id=N`` and replaces that partition when it is run again
after a failure, so nothing is counted twice.  What holds is, per window and key, the row of the
latest micro-batch; ``latest`` reads it, and ``fold`` rewrites the batches so far as one, so that the
number of files stays small."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from lansight.operators.windows import WindowRule

c = F.col


def stream_rule_early(packets: DataFrame, rule: WindowRule) -> DataFrame:
    """A window rule as one stateful aggregate for update mode (chained aggregates are refused there): the
    state of a (window, key) holds its distinct values until the watermark passes the window."""
    aggs = []
    for m in rule.measures:
        if m.kind == "count":
            v = F.count(F.lit(1))
        elif m.kind in ("distinct", "set_size"):
            v = F.size(F.collect_set(m.cols[0])).cast("bigint" if m.kind == "distinct" else "int")
        elif m.kind == "pairs":
            v = F.size(F.collect_set(F.struct(*m.cols)))
        else:
            v = F.min(rule.time_col) if m.kind == "first" else F.max(rule.time_col)
        aggs.append(v.alias(m.alias))
    return rule.project(packets.filter(rule.where()).groupBy(rule.window().alias("window"), c(rule.key)).agg(*aggs))


def upsert_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """A micro-batch's changed rows; run again, it replaces what it wrote."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def early_sink(df: DataFrame, path: str, checkpoint: str, name: str | None = None) -> DataStreamWriter:
    def write(rows: DataFrame, batch_id: int) -> None:
        upsert_batch(rows, batch_id, path)

    w = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return w.queryName(name) if name else w


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Per key the row of the latest micro-batch that reported it."""
    rows = spark.read.option("basePath", path).parquet(path)
    own = [x for x in rows.columns if x not in (*keys, "batch_id")]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*own), "batch_id").alias("row"))
    columns = [x for x in rows.columns if x != "batch_id"]
    return best.select(*[c(x) if x in keys else c(f"row.`{x}`") for x in columns])


def fold(spark: SparkSession, path: str, keys: Sequence[str], target: str) -> None:
    """The batches so far as one table at ``target`` (readers move there; the old folder can then go)."""
    latest(spark, path, keys).write.mode("overwrite").parquet(f"{target}/batch_id=-1")
