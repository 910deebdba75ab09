"""Top talkers per time window from bounded frequency sketches (T2, batch or stream).

A window's state is one sketch of at most ``capacity`` senders (``approx_top_k_accumulate``), filled
per task and merged, instead of a row per sender, so an address scan with forged senders can't blow
it up and one busy sender is no hot key.

Bounds: a reported count is never too low, and too high by at most ``sketch_error`` of the window's
packets.  Where the counts add up to the window's packets nothing was ever evicted, and they are
exact.  The answer holds every sender that can be among the ``k`` busiest, so the true ones are always
in it; with exact counts it is just these (ties included).  Packets without a sender don't count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

c = F.col


def sketch_error(capacity: int) -> float:
    """Share of a window's packets by which a count may be too high: 3.5 over the sketch's map size, the
    power of two that holds ``capacity`` items at three quarters."""
    return 3.5 / 2 ** (-(-capacity * 4 // 3) - 1).bit_length()


def window_sketches(df: DataFrame, window_seconds: int = 60, capacity: int = 4096, by: str = "eth_src") -> DataFrame:
    """(window, packets, sketch): mergeable, one row a window."""
    return df.filter(c(by).isNotNull()).groupBy(F.window("event_ts", f"{window_seconds} seconds").alias("window")).agg(
        F.count(F.lit(1)).alias("packets"), F.expr(f"approx_top_k_accumulate({by}, {int(capacity)})").alias("sketch"))


def talkers_of(sketches: DataFrame, k: int = 10, capacity: int = 4096, by: str = "eth_src") -> DataFrame:
    """(window_start, window_end, sender, packet_count, max_error) of every sender that can be among a
    window's ``k`` busiest."""
    held = sketches.withColumn("items", F.expr(f"approx_top_k_estimate(sketch, {int(capacity)})"))
    exact = F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + x["count"]) == c("packets")
    error = F.when(exact, 0).otherwise(F.ceil(c("packets") * F.lit(sketch_error(capacity)))).cast("bigint")
    lower = F.sort_array(F.transform("items", lambda x: x["count"] - c("max_error")), asc=False)
    least = F.coalesce(F.get(lower, k - 1), F.lit(0))
    rows = held.withColumn("max_error", error).withColumn("least", least) \
        .select("window", "max_error", F.explode(F.filter("items", lambda x: x["count"] >= c("least"))).alias("x"))
    return rows.select(c("window.start").alias("window_start"), c("window.end").alias("window_end"),
                       c("x.item").alias(by), c("x.count").cast("bigint").alias("packet_count"), "max_error")


def window_top_talkers(df: DataFrame, k: int = 10, window_seconds: int = 60, capacity: int = 4096) -> DataFrame:
    """Batch, or a stream with a watermark upstream (windows come when they are final)."""
    return talkers_of(window_sketches(df, window_seconds, capacity), k, capacity)
