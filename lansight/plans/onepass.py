"""All nine detectors' alerts in two reads of the packets.

The window rules and the reply check share one pass: a packet is tagged with every rule family whose
filter it meets and the windows it falls into, and a generic two-step aggregate runs over the tags.

* level 1 groups by (family, window, key, values), with a count per rule of the family.  It is a
  partial aggregate before any shuffle, so a hot key collapses where it is read;
* level 2 counts distinct values: each level-1 row gives one row per *facet* (first value, second
  value, both), rows of a facet that agree are folded, and what is left is counted per
  (family, window, key) and rule.  All of level 2 runs on one hash partitioning by that group;
* each group then turns into the alerts of the rules whose threshold it meets.

Unanswered replies need requests and replies of a pair together: a second pass folds both per (pair,
bucket of seconds), requests to one bit mask, and a window over the folded rows gives every reply the
mask.  Where times have fractions, the as-of plan of ``operators.joins`` takes its place.

The detections themselves (all their columns) stay with ``plans.batch``; this is for the alert table
and what is counted from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lansight.config import DEFAULT, ArpConfig
from lansight.operators import joins, rules
from lansight.operators.windows import WindowRule, _family_dcols, _family_key
from lansight.plans.report import _PROJECTIONS, ALERT_COLUMNS, DETECTORS, _detail, alert_projection

c = F.col
GROUP = ("f", "w", "k", "e1", "e2")
EVENTS = -1  # family of the alerts that are packets themselves


def _families(cfg: ArpConfig) -> list[list[WindowRule]]:
    """Rules of one window and key, as long as they count at most two columns' distinct values."""
    out: list[list[WindowRule]] = []
    for r in rules.standard_rules(cfg):
        home = next((f for f in out if _family_key(f[0]) == _family_key(r) and len(_family_dcols([*f, r])) <= 2), None)
        if home is None:
            out.append([r])
        else:
            home.append(r)
    return out


def _tags(families: list[list[WindowRule]], width: int, replies: bool = True) -> Column:
    """Array of (f, w, k, v1, v2, h0..): one element per family and window that the packet counts in, and
    with ``replies`` one for a forged reply."""
    us = F.unix_micros("event_ts")
    none, tags = F.lit(None).cast("string"), []

    def tag(hit, f, w, k, v1, v2, hits):
        hits = [*hits, *[F.lit(0)] * (width - len(hits))]
        return F.when(hit, F.struct(F.lit(f).alias("f"), w.alias("w"), c(k).alias("k"), v1.alias("v1"), v2.alias("v2"),
                                    *[h.alias(f"h{i}") for i, h in enumerate(hits)]))

    for f, family in enumerate(families):
        lead, values = family[0], _family_dcols(family)
        if len(values) > 2:
            raise ValueError("a family may count two columns' distinct values")
        v = [c(x) for x in values] + [none] * (2 - len(values))
        wheres = [F.coalesce(r.where(), F.lit(False)) for r in family]
        hit = c("event_ts").isNotNull()
        if len(wheres) == 1:
            hit = hit & wheres[0]
        else:
            some = wheres[0]
            for w in wheres[1:]:
                some = some | w
            hit = hit & some
        slide = (lead.slide or lead.size) * 1_000_000
        start = us - F.pmod(us, F.lit(slide))
        for back in range(0, lead.size * 1_000_000, slide):
            inside = hit if back + slide <= lead.size * 1_000_000 else hit & (us < start - back + lead.size * 1_000_000)
            tags.append(tag(inside, f, start - back, lead.key, *v, [w.cast("int") for w in wheres]))
    if not replies:
        return F.array(*tags)
    mismatch = F.coalesce(c("is_reply") & c("has_mac_mismatch"), F.lit(False))
    tags.append(tag(mismatch, EVENTS, us, "eth_src", c("arp_src_mac"), c("arp_src_ip"), [F.lit(1)]))
    return F.array(*tags)


def _groups(packets: DataFrame, families: list[list[WindowRule]]) -> DataFrame:
    """One row per (family, window, key): per rule i its packets n_i, its distinct values d1_i and d2_i, and
    its distinct pairs of values p_i.  Packets that are alerts themselves have their values as e1, e2."""
    width = max(len(family) for family in families)
    per_rule = range(width)
    level1 = packets.select(F.explode(_tags(families, width)).alias("t")).where("t IS NOT NULL").select("t.*") \
        .groupBy("f", "w", "k", "v1", "v2").agg(*[F.sum(f"h{i}").alias(f"n{i}") for i in per_rule])
    event = c("f") == EVENTS
    two = c("f").isin(*[f for f, family in enumerate(families) if len(_family_dcols(family)) == 2])
    none = F.lit(None).cast("string")

    def facet(number, v, a, b):
        return F.struct(F.lit(number).alias("facet"), v.alias("v"), a.alias("a"), b.alias("b"))

    # facet 0: the row itself (its packets, and a distinct pair), 1 and 2: the first and the second value
    facets = F.when(two, F.array(facet(0, none, c("v1"), c("v2")), facet(1, c("v1"), none, none), facet(2, c("v2"), none, none))) \
        .otherwise(F.array(facet(3, none, c("v1"), c("v2"))))
    e1, e2 = F.when(event, c("v1")), F.when(event, c("v2"))
    grouped = level1.select("f", "w", "k", e1.alias("e1"), e2.alias("e2"), *[f"n{i}" for i in per_rule],
                            F.explode(facets).alias("x")) \
        .select(*GROUP, *[f"n{i}" for i in per_rule], "x.*").repartition(*[c(g) for g in GROUP])
    folded = grouped.groupBy(*GROUP, "facet", "v", "a", "b").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in per_rule])
    own, counts = c("facet").isin(0, 3), []
    for i in per_rule:
        hit = c(f"n{i}") > 0
        first = F.when(c("facet") == 1, c("v")).when(c("facet") == 3, c("a"))
        counts += [F.sum(F.when(own, c(f"n{i}")).otherwise(0)).alias(f"n{i}"),
                   F.count(F.when(hit, first)).alias(f"d1_{i}"),
                   F.count(F.when(hit & (c("facet") == 2), c("v"))).alias(f"d2_{i}"),
                   F.count(F.when(hit & own, 1)).alias(f"p_{i}")]
    return folded.groupBy(*GROUP).agg(*counts)


def _measures(rule: WindowRule, i: int, values: list[str]) -> dict[str, Column]:
    """What the rule calls its measures, over a group's counts (times are not among an alert's columns)."""
    out = {}
    for m in rule.measures:
        if m.kind == "count":
            out[m.alias] = c(f"n{i}")
        elif m.kind in ("distinct", "set_size"):
            out[m.alias] = c(f"d{values.index(m.cols[0]) + 1}_{i}")
        elif m.kind == "pairs":
            out[m.alias] = c(f"p_{i}")
    return out


def _alert(name: str, ts: Column, entity: Column, metric: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("detector"), ts.alias("ts"), entity.alias("entity"),
                    metric.cast("bigint").alias("metric"), detail.alias("detail"))


def _rule_alerts(out: DataFrame, families: list[list[WindowRule]]) -> tuple[DataFrame, list[str]]:
    """The groups with a column for each rule, its alert or null, and these columns' names."""
    ts = F.timestamp_micros(c("w"))
    columns, alerts = out.columns, []
    for f, family in enumerate(families):
        for i, rule in enumerate(family):
            _, _, metric, detail = _PROJECTIONS[rule.name]
            out = out.withColumns(_measures(rule, i, _family_dcols(family)))
            mine = (c("f") == f) & (c(f"n{i}") > 0) & rule.having()
            alert = _alert(rule.name, ts, c("k"), c(metric), _detail(*detail))
            out = out.select(*columns, *alerts, F.when(mine, alert).alias(f"alert_{rule.name}"))
            alerts.append(f"alert_{rule.name}")
    return out, alerts


def window_and_reply_alerts(packets: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """The alerts of the seven window rules and of forged replies, from one read of the packets."""
    families = _families(cfg)
    out, alerts = _rule_alerts(_groups(packets, families), families)
    name = "spoof_reply_mismatch"
    forged = _alert(name, F.timestamp_micros(c("w")), c("k"), F.lit(1), _detail(("claimed_mac", "e1"), ("claimed_ip", "e2")))
    repeated = F.when(c("f") == EVENTS, F.array_repeat(forged, c("n0").cast("int"))) \
        .otherwise(F.array_compact(F.array(*alerts)))
    return out.select(F.explode(repeated).alias("a")).select(*[f"a.{x}" for x in ALERT_COLUMNS])


def _stream_groups(packets: DataFrame, families: list[list[WindowRule]]) -> DataFrame:
    """``_groups`` of a stream, without forged replies: two chained stateful aggregates for all families.

    The end of a tag's window takes over what marks the event time as watermarked, as ``F.window`` does, so
    that a group is final, and a packet late, when the watermark has passed its own window."""
    width = max(len(family) for family in families)
    per_rule = range(width)
    size = F.element_at(F.array(*[F.lit(family[0].size * 1_000_000).cast("long") for family in families]), c("f") + 1)
    end = F.timestamp_micros(c("w") + size).alias("end", metadata=packets.schema["event_ts"].metadata)
    level1 = packets.select(F.explode(_tags(families, width, replies=False)).alias("t")).where("t IS NOT NULL") \
        .select("t.*").select("f", end, "k", "v1", "v2", *[f"h{i}" for i in per_rule]) \
        .groupBy("f", "end", "k", "v1", "v2").agg(*[F.sum(f"h{i}").alias(f"n{i}") for i in per_rule])
    # with one column of values each of them is one row of its group; only families with two need sets
    two = c("f").isin(*[f for f, family in enumerate(families) if len(_family_dcols(family)) == 2])
    counts = []
    for i in per_rule:
        hit = c(f"n{i}") > 0
        counts += [F.sum(f"n{i}").alias(f"n{i}"), F.count(F.when(hit, 1)).alias(f"p_{i}"),
                   (F.count(F.when(hit & ~two, c("v1"))) + F.size(F.collect_set(F.when(hit & two, c("v1"))))).alias(f"d1_{i}"),
                   F.size(F.collect_set(F.when(hit & two, c("v2")))).alias(f"d2_{i}")]
    return level1.groupBy("f", "end", "k").agg(*counts).withColumn("w", F.unix_micros("end") - size)


def stream_window_alerts(packets: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """The alerts of the seven window rules on a stream, each as its window becomes final."""
    families = _families(cfg)
    out, alerts = _rule_alerts(_stream_groups(packets, families), families)
    return out.select(F.explode(F.array_compact(F.array(*alerts))).alias("a")).select(*[f"a.{x}" for x in ALERT_COLUMNS])


def unsolicited_alerts(packets: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """The alerts of unanswered replies, from one read of the packets."""
    span = cfg.unsolicited_lookback
    if cfg.time_precision != "seconds" or span + 1 > 62:
        return alert_projection("unsolicited", joins.detect_unsolicited(packets, cfg))
    width = max(60, span + 1)
    sec = F.unix_seconds("event_ts")
    kept = packets.filter(c("is_reply") | (c("is_request") & c("arp_src_ip").isNotNull() & c("arp_dst_ip").isNotNull()
                                           & c("event_ts").isNotNull()))
    reply = c("is_reply")
    sides = kept.select(
        reply.alias("reply"), sec.alias("s"),
        F.when(reply, c("arp_src_ip")).otherwise(c("arp_dst_ip")).alias("ip"),
        F.when(reply, c("arp_dst_ip")).otherwise(c("arp_src_ip")).alias("peer"),
        F.when(reply, c("eth_src")).alias("mac"), F.when(reply, c("arp_src_mac")).alias("advertised"),
        F.when(reply, F.array(F.floor(sec / width))).otherwise(
            F.array_distinct(F.array(F.floor(sec / width), F.floor((sec + span) / width)))).alias("buckets"))
    rows = sides.select("reply", "s", "ip", "peer", "mac", "advertised", F.explode("buckets").alias("bucket"))
    low = (F.greatest(c("s"), c("bucket") * width) - c("bucket") * width).cast("int")
    high = (F.least(c("s") + span, c("bucket") * width + (width - 1)) - c("bucket") * width).cast("int")
    bits = rows.withColumns({"low": low, "high": high}).withColumns({
        "bits": F.expr("CASE WHEN NOT reply THEN shiftleft(1L, high + 1) - shiftleft(1L, low) END"),
        "s": F.when(c("reply"), c("s"))})
    folded = bits.groupBy("ip", "peer", "bucket", "reply", "s", "mac", "advertised").agg(
        F.count(F.lit(1)).alias("n"), F.bit_or("bits").alias("bits"))
    asked = F.bit_or("bits").over(Window.partitionBy("ip", "peer", "bucket"))
    at = (c("s") - c("bucket") * width).cast("int")
    open_ = folded.withColumn("asked", asked).filter(c("reply")).withColumn("at", at) \
        .filter(F.expr("asked IS NULL OR ip IS NULL OR peer IS NULL OR s IS NULL OR (shiftright(asked, at) & 1) = 0"))
    each = open_.select("s", "ip", "mac", "advertised", F.explode(F.array_repeat(F.lit(1), c("n").cast("int"))).alias("_"))
    return each.select(F.lit("unsolicited").alias("detector"), F.timestamp_seconds(c("s")).alias("ts"),
                       c("mac").alias("entity"), F.lit(1).cast("bigint").alias("metric"),
                       _detail(("ip", "ip"), ("advertised_mac", "advertised")).alias("detail"))


def alerts(packets: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """The unified alert table."""
    return window_and_reply_alerts(packets, cfg).union(unsolicited_alerts(packets, cfg))


def counts(packets: DataFrame, cfg: ArpConfig = DEFAULT) -> DataFrame:
    """One row with the number of alerts of each detector, for the summary, the status and the score."""
    names = [name for name, _ in DETECTORS]
    table = alerts(packets, cfg).groupBy("detector").agg(F.count(F.lit(1)).alias("n"))
    return table.agg(*[F.coalesce(F.sum(F.when(c("detector") == n, c("n"))), F.lit(0)).alias(n) for n in names])
