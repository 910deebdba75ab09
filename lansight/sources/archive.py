"""Raw captures archived as Parquet partitioned by capture date.

The archive is the "silver" input for large runs: rules then read only the
columns they use, and a date predicate prunes whole folders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from lansight.functions.timefn import clean_epoch_sql
from lansight.schema import CORRUPT_COLUMN, RAW_COLUMNS, RAW_SCHEMA, RAW_SCHEMA_WITH_CORRUPT
from lansight.session import remove_path

# an archive's schema is fixed, so reading needs no inference and an empty capture reads as no rows
ARCHIVE_SCHEMA = StructType(RAW_SCHEMA_WITH_CORRUPT.fields + [StructField("date", StringType(), True)])
# the stream's ingest table: with the lines that did not parse, and set-aside packets in a folder of their own
SILVER_SCHEMA = StructType(RAW_SCHEMA_WITH_CORRUPT.fields + [StructField("aside", BooleanType(), True),
                                                             StructField("date", StringType(), True)])


def capture_date(raw: DataFrame):
    """UTC calendar date of the packet, independent of the session zone; null without a valid time."""
    days = F.floor(F.expr(clean_epoch_sql("`frame.time_epoch`")) / F.lit(86400.0)).cast("int")
    return F.date_from_unix_date(days).cast("string")


def write_archive(raw: DataFrame, path: str, mode: str = "append") -> None:
    """Packets by capture date; those without a valid time have a partition of their own."""
    (raw.withColumn("date", capture_date(raw))
     .write.mode(mode).partitionBy("date").parquet(path))


def read_archive(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    df = spark.read.schema(ARCHIVE_SCHEMA).parquet(path)
    if dates:
        df = df.filter(F.col("date").isin(*dates))
    return df.select(*[F.col(f"`{n}`") for n in RAW_COLUMNS])


def read_corrupt(spark: SparkSession, path: str) -> DataFrame:
    """The capture lines that did not parse, as they were, with the date they were filed under."""
    df = spark.read.schema(ARCHIVE_SCHEMA).parquet(path)
    return df.where(F.col(CORRUPT_COLUMN).isNotNull()).select("date", F.col(CORRUPT_COLUMN).alias("line"))


def read_silver_stream(spark: SparkSession, path: str) -> DataFrame:
    """The ingest table as a stream of packets, without those set aside."""
    df = spark.readStream.schema(SILVER_SCHEMA).parquet(path)
    return df.where(~F.col("aside")).select(*[F.col(f"`{n}`") for n in RAW_COLUMNS])


def read_set_aside(spark: SparkSession, path: str) -> DataFrame:
    """The packets that the clock guard kept from the detectors."""
    df = spark.read.schema(SILVER_SCHEMA).parquet(path)
    return df.where(F.col("aside")).select(*[F.col(f"`{n}`") for n in RAW_COLUMNS], "date")


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(date, files, bytes) of an archive."""
    files = spark.read.schema(ARCHIVE_SCHEMA).parquet(path) \
        .select("date", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).distinct()
    return files.groupBy("date").agg(F.count("*").alias("files"), F.sum("b").alias("bytes"))


def compact_archive(spark: SparkSession, path: str, target_bytes: int = 128 << 20) -> list[str]:
    """Rewrite the dates that lie in more files than their size asks for, as few files sorted by sender (a
    reader of one sender then skips row groups).  Captures roll every few packets, so an archive they are
    appended to has many small files.  Returns the dates rewritten; a second run finds nothing to do.

    The rows are staged beside the archive first and each date is replaced as a whole (dynamic partition
    overwrite), so a run that fails half way leaves every date in one of its two forms and the staged rows
    for the other.  Not for a folder that a stream reads: its rewritten files would come as new ones."""
    sizes = file_sizes(spark, path).where("date IS NOT NULL") \
        .withColumn("needed", F.ceil(F.col("bytes") / F.lit(target_bytes)))
    due = sizes.where("files > needed").orderBy("date").collect()  # a row a date
    if not due:
        return []
    dates = [r["date"] for r in due]
    needed = F.broadcast(spark.createDataFrame([(r["date"], int(r["needed"])) for r in due], "date string, needed int"))

    def files_of(rows: DataFrame) -> DataFrame:
        """A file per slice of a day, as many as the day needs, each sorted by sender."""
        time = F.expr(clean_epoch_sql("`frame.time_epoch`"))
        part = F.floor(F.pmod(time, F.lit(86400.0)) * F.col("needed") / 86400.0)
        keys = [F.col(k) for k in ("date", "`eth.src`", "`frame.time_epoch`")]
        return rows.join(needed, "date").withColumn("part", part).repartition("date", "part") \
            .sortWithinPartitions(*keys).select(*[F.col(f"`{f.name}`") for f in ARCHIVE_SCHEMA])

    stage = f"{path.rstrip('/')}/_compacting-{uuid.uuid4().hex[:12]}"
    rows = spark.read.schema(ARCHIVE_SCHEMA).parquet(path).where(F.col("date").isin(*dates))
    files_of(rows).write.partitionBy("date").parquet(stage)
    files_of(spark.read.schema(ARCHIVE_SCHEMA).parquet(stage)) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    remove_path(spark, stage)
    return dates
