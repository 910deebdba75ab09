"""Sliding windows from panes, with mergeable sketches.

A sliding window is a whole number of *panes*, the stretches between neighbouring window borders.
Each packet is counted once, in its pane; panes, not packets, are then copied into the windows that
hold them.  Distinct values are kept per pane and key in a HyperLogLog sketch (``hll_sketch_agg``),
and a window's sketch is the union of its panes' (``hll_union_agg``), so neither the size of a pane's
row nor of the state of a stream grows with the number of distinct values.

Error: with 2**lg_k registers the standard error of the union's estimate is about
``hll_error(lg_k)``; up to a few hundred values the sketch holds them one by one and the rounded
estimate is exact."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lansight.operators.windows import WindowRule

c = F.col
LG_K = 12


def hll_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a union of HyperLogLog sketches."""
    return 1.04 / math.sqrt(2 ** lg_k)


def pane_seconds(rule: WindowRule) -> int:
    return math.gcd(rule.size, rule.slide or rule.size)


def pane_table(df: DataFrame, rule: WindowRule, lg_k: int = LG_K) -> DataFrame:
    """(pane, key, packets, first, last, one sketch per distinct column): mergeable, so it can be written
    and merged later into windows of any size that panes add up to."""
    pane = F.window(rule.time_col, f"{pane_seconds(rule)} seconds")
    aggs = [F.count(F.lit(1)).alias("packets"), F.min(rule.time_col).alias("first"), F.max(rule.time_col).alias("last")]
    aggs += [F.hll_sketch_agg(x, lg_k).alias(f"sketch_{x}") for x in rule.distinct_cols]
    return df.filter(rule.where()).groupBy(pane.alias("pane"), c(rule.key)).agg(*aggs)


def windows_of_panes(panes: DataFrame, rule: WindowRule) -> DataFrame:
    """The rule's result from its panes.  Pairs of columns have no sketch here."""
    at = F.window_time("pane")  # inside the pane, and what a stream's watermark goes by
    window = F.window(at, f"{rule.size} seconds", f"{rule.slide or rule.size} seconds")
    aggs = []
    for m in rule.measures:
        if m.kind == "count":
            v = F.sum("packets").cast("bigint")
        elif m.kind in ("distinct", "set_size"):
            v = F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{m.cols[0]}")).cast(
                "bigint" if m.kind == "distinct" else "int")
        elif m.kind in ("first", "last"):
            v = F.min("first") if m.kind == "first" else F.max("last")
        else:
            raise ValueError(f"no sketch for {m.kind}")
        aggs.append(v.alias(m.alias))
    return rule.project(panes.groupBy(window.alias("window"), rule.key).agg(*aggs))


def compile_panes(df: DataFrame, rule: WindowRule, lg_k: int = LG_K) -> DataFrame:
    """Batch or stream (with a watermark upstream): two chained aggregates, a row per pane and key between."""
    return windows_of_panes(pane_table(df, rule, lg_k), rule)
