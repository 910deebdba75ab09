"""Clocks that can't be right (W1): they must not move a stream's watermark.

The watermark follows the largest event time seen, so a single packet dated years ahead would make
every later packet late and end all detections silently.  Event times are therefore held against the
packet's *arrival* at ingest: the time its capture file was written, or the broker's record time.
Both belong to the record, not to the run, so a replay decides alike.  A packet dated more than
``clock_ahead_seconds`` after its arrival is set aside: kept in the ingest table under
``aside = true`` with its reason, out of the detectors' sight.  Packets without a time stay, as in a
batch run (windows skip them, reply checks report them); they can't move a watermark.

What a replay of an old capture can't tell is a clock that is ahead of its neighbours but behind the
file's own date; choose a smaller allowance, or cut captures into files as they roll."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lansight.config import DEFAULT, ArpConfig
from lansight.functions.timefn import clean_epoch_sql
from lansight.schema import ARRIVAL, CORRUPT_COLUMN

#: Name of the counts that the ingest query reports with each micro-batch.
INGEST_COUNTS = "ingest"


def clock_ahead(cfg: ArpConfig = DEFAULT, arrival: Column | None = None) -> Column:
    """True for a packet dated later than its arrival allows; a missing time or arrival is no reason."""
    at = F.col(ARRIVAL) if arrival is None else arrival
    epoch = F.expr(clean_epoch_sql("`frame.time_epoch`"))
    return F.coalesce(epoch > F.unix_seconds(at) + F.lit(cfg.clock_ahead_seconds), F.lit(False))


def plausible(raw: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """The packets of ``raw`` (with its arrival column) that may feed a watermark."""
    return raw.filter(~clock_ahead(cfg)).drop(ARRIVAL)


def mark_aside(raw: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """``raw`` with ``aside``, its arrival column gone, and the counts of the ingest observed: packets,
    those set aside, those without a usable time, and lines that did not parse."""
    timeless = F.expr(f"{clean_epoch_sql('`frame.time_epoch`')} IS NULL")
    corrupt = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in raw.columns else F.lit(False)
    out = raw.withColumn("aside", clock_ahead(cfg))
    return out.observe(
        INGEST_COUNTS, F.count(F.lit(1)).alias("packets"), F.count(F.when(F.col("aside"), 1)).alias("set_aside"),
        F.count(F.when(timeless, 1)).alias("without_time"), F.count(F.when(corrupt, 1)).alias("corrupt_lines"),
    ).drop(ARRIVAL)
