"""CSV packet sources (batch and Structured Streaming) and the CSV writer used
to stage captures.  The schema is fixed, never inferred; fields match by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lansight.config import DEFAULT, ArpConfig
from lansight.schema import ARRIVAL, CORRUPT_COLUMN, RAW_SCHEMA, RAW_SCHEMA_WITH_CORRUPT


def _reader(r, keep_corrupt: bool, header: bool = True):
    r = r.option("header", str(header).lower()).option("mode", "PERMISSIVE")
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).schema(RAW_SCHEMA_WITH_CORRUPT)
    else:
        r = r.schema(RAW_SCHEMA)
    return r


def read_csv_batch(spark: SparkSession, path: str, keep_corrupt: bool = False, header: bool = True,
                   trim: bool = False) -> DataFrame:
    """A folder (or glob) of capture CSV files.  Bad or missing fields become
    null and the row is kept; ``keep_corrupt`` adds the offending line text (S6).
    ``trim`` strips white space around fields before parsing, as the stream scan
    does, so an opcode written as " 1 " parses (off by default: the batch scan
    of the original keeps fields as they are; doubles parse either way)."""
    r = spark.read
    if trim:
        r = r.option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true")
    return _reader(r, keep_corrupt, header).csv(path)


def read_csv_stream(spark: SparkSession, path: str, cfg: ArpConfig = DEFAULT,
                    max_files_per_trigger: int | None = None, keep_corrupt: bool = False,
                    arrival: bool = False) -> DataFrame:
    """The same folder as a stream of new ``*.csv`` files, taken in
    modification-time order, ``max_files_per_trigger`` per micro-batch.
    ``arrival`` adds the time each packet's file was written (for the clock guard)."""
    mf = cfg.max_files_per_trigger if max_files_per_trigger is None else max_files_per_trigger
    r = spark.readStream
    if mf:  # 0 = no limit: every new file in one micro-batch
        r = r.option("maxFilesPerTrigger", mf)
    r = (r.option("pathGlobFilter", "*.csv")
         .option("recursiveFileLookup", "false")
         .option("ignoreLeadingWhiteSpace", "true")
         .option("ignoreTrailingWhiteSpace", "true"))
    out = _reader(r, keep_corrupt).csv(path)
    return out.select("*", F.col("_metadata.file_modification_time").alias(ARRIVAL)) if arrival else out


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write raw packets as capture CSV (header, white space kept as is)."""
    (df.write.mode(mode).option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
