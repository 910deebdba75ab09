"""Traffic profile of the packet table: timeline, talkers, opcode mix, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lansight.functions.normalize import opcode_label
from lansight.functions.timefn import second_string

c = F.col

_DAY = 86_400


def _flag(col: str):
    return F.coalesce(F.sum(c(col).cast("int")), F.lit(0)).cast("bigint")


def dense_seconds(per_second: DataFrame, sec_col: str = "sec") -> DataFrame:
    """Every second between the first and last second of ``per_second``.

    Generated in two steps (days, then the seconds of each day) behind a
    fixed-count repartition, so a long capture, or one wrong clock, is spread over
    all tasks instead of being expanded by the single task that holds the bounds.
    The bounds read every column of ``per_second``: so they keep the plan of the
    branch that is joined to them, and the packets are scanned and shuffled once.
    """
    spark = per_second.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = F.struct(sec_col, *[x for x in per_second.columns if x != sec_col])
    bounds = per_second.agg(F.min(row)[sec_col].alias("lo"), F.max(row)[sec_col].alias("hi"))
    days = bounds.select("lo", "hi", F.explode(F.sequence(F.floor(c("lo") / _DAY), F.floor(c("hi") / _DAY))).alias("d"))
    return days.repartition(parts, "d").select(
        F.explode(F.sequence(F.greatest(c("d") * _DAY, c("lo")), F.least(c("d") * _DAY + _DAY - 1, c("hi")))).alias(sec_col))


def _per_second(df: DataFrame) -> DataFrame:
    return (df.filter(c("event_ts").isNotNull())
            .groupBy(F.unix_seconds(c("event_ts")).alias("sec"))
            .agg(F.count(F.lit(1)).alias("packets"), _flag("is_request").alias("requests"),
                 _flag("is_reply").alias("replies"), _flag("is_gratuitous").alias("garps")))


COUNTS = ("packets", "requests", "replies", "garps")


def timeline_runs(df: DataFrame) -> DataFrame:
    """T1 as runs: (sec, seconds, packets, requests, replies, garps).  A busy second is a run of one, the
    idle seconds behind it are one run with zeros, however long: the rows grow with the busy seconds, and
    a packet with a wrong clock costs two rows.

    The second after a busy one comes from ``lead`` within its day; a day's last second looks up the next
    day's first, one row a day."""
    # the null test that the join below needs is made for both branches here, which keeps their plans equal
    per = _per_second(df).withColumn("day", F.floor(c("sec") / _DAY)).filter(c("day").isNotNull())
    ahead = F.lead("sec").over(Window.partitionBy("day").orderBy("sec"))
    within = per.withColumn("next", ahead)
    # the whole row, so that this branch keeps the plan of the other and the packets are read once
    days = per.groupBy("day").agg(F.min(F.struct("sec", *COUNTS))["sec"].alias("first"))
    after = days.select("day", F.lead("first").over(Window.orderBy("day")).alias("next_day"))
    busy = within.join(after, "day").withColumn("idle", F.coalesce("next", "next_day") - c("sec") - 1)
    zeros = [F.lit(0).cast("bigint").alias(x) for x in COUNTS]
    runs = F.array(F.struct(c("sec").alias("sec"), F.lit(1).cast("bigint").alias("seconds"), *COUNTS),
                   F.when(c("idle") > 0, F.struct((c("sec") + 1).alias("sec"), c("idle").alias("seconds"), *zeros)))
    return busy.select(F.explode(F.array_compact(runs)).alias("r")).select("r.*")


def timeline_table(df: DataFrame) -> DataFrame:
    """The runs as the profile stores them: first second as text, length in seconds, counts per second."""
    return timeline_runs(df).select(second_string(F.timestamp_seconds(c("sec"))).alias("second"), "seconds", *COUNTS)


def traffic_timeline(df: DataFrame, since: int | None = None, until: int | None = None) -> DataFrame:
    """Requests / replies / GARPs per second, gap seconds filled with 0.  ``since`` and ``until`` (epoch
    seconds, both included) choose the part that is written out second by second; without them it is all
    the time from the first packet to the last, which one wrong clock makes long (see ``timeline_runs``)."""
    per = _per_second(df).drop("packets")
    if since is None or until is None:
        full = dense_seconds(per)
        if since is not None:
            full = full.filter(c("sec") >= since)
        if until is not None:
            full = full.filter(c("sec") <= until)
        full = full.join(per, "sec", "left")
    else:
        inside = per.filter(c("sec").between(since, until))
        spark = df.sparkSession
        full = spark.range(since, until + 1).withColumnRenamed("id", "sec").join(inside, "sec", "left")
    return full.select(
        second_string(F.timestamp_seconds(c("sec"))).alias("second"),
        *[F.coalesce(c(x), F.lit(0)).cast("bigint").alias(x) for x in ("requests", "replies", "garps")],
    )


def packet_rate(df: DataFrame) -> DataFrame:
    """Packets per second over the capture span (idle seconds count as 0), from the busy seconds alone:
    what lies between the first and the last of them and is not busy is idle."""
    per = _per_second(df)
    span = F.max("sec") - F.min("sec") + 1
    return per.agg(
        F.timestamp_seconds(F.min("sec")).alias("first_second"),
        F.timestamp_seconds(F.max("sec")).alias("last_second"),
        F.coalesce(span, F.lit(0)).alias("span_seconds"),
        F.sum("packets").cast("bigint").alias("packets"),
        (F.sum("packets") / span).cast("double").alias("mean_pps"),
        F.max("packets").cast("bigint").alias("peak_pps"),
        F.coalesce(span - F.count(F.lit(1)), F.lit(0)).alias("idle_seconds"),
    )


def top_talkers(df: DataFrame, k: int = 10) -> DataFrame:
    """The k busiest Ethernet sources with their distinct targets (top-k report).

    Ties on the count are broken by MAC so the answer is deterministic.
    """
    per_target = df.groupBy("eth_src", "arp_dst_ip").agg(F.count(F.lit(1)).alias("n"))
    per_src = per_target.groupBy("eth_src").agg(
        F.sum("n").cast("bigint").alias("packet_count"), F.count("arp_dst_ip").alias("unique_targets"))
    return per_src.orderBy(c("packet_count").desc(), c("eth_src").asc_nulls_first()).limit(k)


def top_requesters(df: DataFrame, k: int = 10) -> DataFrame:
    """The k sources sending the most requests."""
    return (df.filter(c("is_request")).groupBy("eth_src").agg(F.count(F.lit(1)).alias("reqs"))
            .orderBy(c("reqs").desc(), c("eth_src").asc_nulls_first()).limit(k))


def opcode_counts(df: DataFrame) -> DataFrame:
    """Packets per opcode; null opcode is its own group."""
    return df.groupBy("opcode").agg(F.count(F.lit(1)).alias("count"))


def opcode_distribution(df: DataFrame) -> DataFrame:
    """T4: T3 with a label (several opcodes may share 'Other')."""
    return opcode_counts(df).select("opcode", "count", opcode_label(c("opcode")).alias("type"))


def packet_totals(df: DataFrame) -> DataFrame:
    """T5: total, requests, replies and GARPs in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(c("is_request")).alias("requests"),
        F.count_if(c("is_reply")).alias("replies"),
        F.count_if(c("is_gratuitous")).alias("garps"),
    )


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """The dashboard's profile as lazy DataFrames (nothing is collected)."""
    return {
        "totals": packet_totals(df),
        "timeline": timeline_table(df),
        "rate": packet_rate(df),
        "top_talkers": top_talkers(df),
        "opcode": opcode_distribution(df),
    }


