"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# First and last second of the TIMESTAMP range (years 1 to 9999).
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def clean_epoch_sql(epoch: str) -> str:
    """Epoch seconds as a DOUBLE inside the timestamp range; null for anything else
    (unparsable text, NaN, infinities, microseconds taken for seconds)."""
    value = f"try_cast({epoch} AS DOUBLE)"
    return f"CASE WHEN {value} BETWEEN {FIRST_SECOND} AND {LAST_SECOND} THEN {value} END"


def event_ts_sql(epoch: str, precision: str = "seconds") -> str:
    """Epoch seconds -> TIMESTAMP, null outside its range.

    ``seconds`` drops the fraction (the reference's behaviour); ``micros`` keeps it.
    """
    clean = clean_epoch_sql(epoch)
    if precision == "seconds":
        return f"timestamp_seconds(CAST({clean} AS BIGINT))"
    if precision == "micros":
        return f"timestamp_micros(CAST(({clean}) * 1000000 AS BIGINT))"
    raise ValueError(f"unknown time precision {precision!r}")


def to_ntz(ts: Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ holding the UTC wall clock, for any session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def second_string(ts: Column) -> Column:
    """UTC 'yyyy-MM-dd HH:mm:ss' text of a TIMESTAMP, independent of the session zone."""
    return F.date_format(to_ntz(ts), "yyyy-MM-dd HH:mm:ss")
