"""JSON packet messages: decoding (S4) and the Kafka stream source (S3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lansight.config import DEFAULT, ArpConfig
from lansight.schema import ARRIVAL, RAW_COLUMNS, RAW_SCHEMA


def encode_packets(raw: DataFrame) -> DataFrame:
    """Raw packets -> one JSON text per packet (column ``value``)."""
    return raw.select(F.to_json(F.struct(*[F.col(f"`{n}`") for n in RAW_COLUMNS])).alias("value"))


def decode_packets(messages: DataFrame, value: Column | str = "value") -> DataFrame:
    """JSON text (or Kafka bytes) -> the nine raw columns; bad JSON -> nulls, row kept."""
    v = F.col(value) if isinstance(value, str) else value
    return messages.select(F.from_json(v.cast("string"), RAW_SCHEMA).alias("data")).select("data.*")


def read_kafka_stream(spark: SparkSession, cfg: ArpConfig = DEFAULT, topic: str | None = None,
                      bootstrap_servers: str | None = None, arrival: bool = False) -> DataFrame:
    """S3: packets from a Kafka topic of JSON values.  Needs the
    spark-sql-kafka package on the classpath (not present in the test image).
    ``arrival`` adds the record's own time (for the clock guard)."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap_servers or cfg.kafka_bootstrap_servers)
           .option("subscribe", topic or cfg.kafka_topic)
           .option("startingOffsets", "latest")
           .option("failOnDataLoss", "false")
           .load())
    if not arrival:
        return decode_packets(raw, "value")
    return raw.select(F.from_json(F.col("value").cast("string"), RAW_SCHEMA).alias("data"),
                      F.col("timestamp").alias(ARRIVAL)).select("data.*", ARRIVAL)
