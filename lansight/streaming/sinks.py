"""Stream sinks (K1-K3) and alert publishing."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from lansight.config import DEFAULT, ArpConfig
from lansight.plans.report import alerts_json


def file_sink(df: DataFrame, path: str, checkpoint: str, name: str | None = None,
              partition_by: Sequence[str] = ()) -> DataStreamWriter:
    """K2: Parquet file sink, append mode, own checkpoint (exactly-once via the sink log)."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return w


def console_sink(df: DataFrame, name: str, output_mode: str = "append") -> DataStreamWriter:
    """K1: console sink for interactive runs."""
    return (df.writeStream.format("console").outputMode(output_mode).option("truncate", "false")
            .option("numRows", 20).queryName(name))


def memory_sink(df: DataFrame, name: str, output_mode: str = "append") -> DataStreamWriter:
    """K3: in-memory table (driver-side; small test streams only)."""
    return df.writeStream.format("memory").outputMode(output_mode).queryName(name)


def kafka_alerts_sink(alerts: DataFrame, checkpoint: str, cfg: ArpConfig = DEFAULT,
                      topic: str = "arp-alerts") -> DataStreamWriter:
    """Alert records as JSON values keyed by detector to a Kafka topic
    (needs the Kafka connector on the classpath)."""
    return (alerts_json(alerts).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", cfg.kafka_bootstrap_servers)
            .option("topic", topic).option("checkpointLocation", checkpoint).outputMode("append"))


def write_alerts_kafka(alerts: DataFrame, cfg: ArpConfig = DEFAULT, topic: str = "arp-alerts") -> None:
    """D15, batch form."""
    (alerts_json(alerts).write.format("kafka").option("kafka.bootstrap.servers", cfg.kafka_bootstrap_servers)
     .option("topic", topic).save())
