"""Declarative event-time window rules and their batch / stream compilers.

A rule is "filter packets, group by (event-time window, key), aggregate, keep
groups over a threshold, project".  It is declared once as a ``WindowRule`` and
compiled two ways:

* batch: a two-level aggregate.  Level 1 groups by (window, key, distinct
  columns) and counts; level 2 groups by (window, key).  Each level is a plain
  partial/final hash aggregate, so a hot key (one flooding MAC) is collapsed
  map-side before any shuffle and no per-group set is ever materialised.
  ``count(distinct c)`` becomes ``count(c)`` over level-1 rows.
* stream: the same two levels as chained stateful aggregates (append mode,
  the watermark propagates from level 1 to level 2).  State is one row per
  (window, key, value) instead of one growing set per (window, key); only rules
  with two distinct columns keep small sets at level 2, over distinct pairs
  (``count(distinct)`` is refused on streams).

Rules that share window and key (MAC flipping, IP flipping, impersonation) can
be compiled together: they then share one level-1 aggregate, i.e. one shuffle
of the packet table for all of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnFn = Callable[[], Column]


@dataclass(frozen=True)
class Measure:
    kind: str  # count | distinct | set_size | pairs | first | last
    alias: str
    cols: tuple[str, ...] = ()


def Count(alias: str) -> Measure:
    return Measure("count", alias)


def Distinct(col: str, alias: str) -> Measure:
    """count(distinct col), nulls skipped, bigint."""
    return Measure("distinct", alias, (col,))


def SetSize(col: str, alias: str) -> Measure:
    """size(collect_set(col)): distinct non-null values, int."""
    return Measure("set_size", alias, (col,))


def Pairs(cols: Sequence[str], alias: str) -> Measure:
    """size(collect_set(struct(cols))): distinct tuples, tuples holding nulls count, int."""
    return Measure("pairs", alias, tuple(cols))


def First(alias: str) -> Measure:
    return Measure("first", alias)


def Last(alias: str) -> Measure:
    return Measure("last", alias)


@dataclass(frozen=True)
class WindowRule:
    name: str
    where: ColumnFn
    key: str
    size: int
    measures: tuple[Measure, ...]
    having: ColumnFn
    output: tuple[tuple[str, ColumnFn], ...]
    slide: int | None = None
    time_col: str = "event_ts"

    @property
    def distinct_cols(self) -> tuple[str, ...]:
        seen: list[str] = []
        for m in self.measures:
            if m.kind in ("distinct", "set_size", "pairs"):
                for c in m.cols:
                    if c not in seen:
                        seen.append(c)
        return tuple(seen)

    def window(self) -> Column:
        if self.slide is None or self.slide == self.size:
            return F.window(self.time_col, f"{self.size} seconds")
        return F.window(self.time_col, f"{self.size} seconds", f"{self.slide} seconds")

    def project(self, grouped: DataFrame) -> DataFrame:
        return grouped.filter(self.having()).select(*[fn().alias(name) for name, fn in self.output])


# ---------------------------------------------------------------------------
# batch
# ---------------------------------------------------------------------------

def _family_key(rule: WindowRule):
    return (rule.size, rule.slide, rule.key, rule.time_col)


def compile_batch(df: DataFrame, rule: WindowRule) -> DataFrame:
    return compile_batch_family(df, [rule])[rule.name]


def compile_batch_family(df: DataFrame, rules: Sequence[WindowRule], stream: bool = False) -> dict[str, DataFrame]:
    """Compile rules sharing (window, key) over one level-1 aggregate.

    ``stream``: level 2 avoids ``count(distinct)`` (refused on streams)."""
    if not rules:
        return {}
    return family_finish(family_level1(df, rules), rules, stream)


def _family_dcols(rules: Sequence[WindowRule]) -> list[str]:
    dcols: list[str] = []
    for r in rules:
        for c in r.distinct_cols:
            if c not in dcols:
                dcols.append(c)
    return dcols


def family_level1(df: DataFrame, rules: Sequence[WindowRule]) -> DataFrame:
    """Level 1 of a rule family: (window, key, distinct columns) with per-rule
    counts and first/last times.  Small next to the packets, so a job can write
    it once as a table and finish every rule of the family from it."""
    fam = {_family_key(r) for r in rules}
    if len(fam) != 1:
        raise ValueError("rules of one family must share window, slide, key and time column")
    lead = rules[0]
    dcols = _family_dcols(rules)
    ts = F.col(lead.time_col)
    single = len(rules) == 1

    # level 1: (window, key, distinct columns) -> per-rule counts and first/last
    level1_aggs = []
    for i, r in enumerate(rules):
        hit = F.lit(True) if single else F.coalesce(r.where(), F.lit(False))
        # count(when(..)) rather than count_if: count_if's rewrite carries per-instance
        # expression ids, which would stop Spark from seeing the family branches as equal
        level1_aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"_n{i}") if not single
                           else F.count(F.lit(1)).alias(f"_n{i}"))
        if any(m.kind == "first" for m in r.measures):
            level1_aggs.append(F.min(F.when(hit, ts)).alias(f"_f{i}"))
        if any(m.kind == "last" for m in r.measures):
            level1_aggs.append(F.max(F.when(hit, ts)).alias(f"_l{i}"))
    if single:
        base = df.filter(lead.where())
    else:
        any_hit = None
        for r in rules:
            cond = F.coalesce(r.where(), F.lit(False))
            any_hit = cond if any_hit is None else (any_hit | cond)
        base = df.filter(any_hit)
    return base.groupBy(lead.window().alias("window"), F.col(lead.key), *[F.col(c) for c in dcols]).agg(*level1_aggs)


def family_finish(level1: DataFrame, rules: Sequence[WindowRule], stream: bool = False) -> dict[str, DataFrame]:
    """Level 2 and the projection of every rule of a family, from its level 1."""
    dcols = _family_dcols(rules)
    single = len(rules) == 1
    out: dict[str, DataFrame] = {}
    # every rule's branch references all level-1 columns (the total is always >= the
    # rule's own count), so column pruning leaves the same level-1 plan in each
    # branch and Spark computes and shuffles it once for the whole family
    total = None
    for f in level1.columns:
        if f.startswith(("_n", "_f", "_l")):
            term = F.col(f) if f.startswith("_n") else F.when(F.col(f).isNull(), 0).otherwise(0)
            total = term if total is None else total + term
    for i, r in enumerate(rules):
        rows = level1 if single else level1.filter((F.col(f"_n{i}") > 0) & (total >= F.col(f"_n{i}")))
        aggs = []
        for m in r.measures:
            if m.kind == "count":
                aggs.append(F.sum(f"_n{i}").cast("bigint").alias(m.alias))
            elif m.kind in ("distinct", "set_size"):
                c = m.cols[0]
                # with c the only level-1 extra key, each non-null value is one row
                if dcols == [c]:
                    v = F.count(c)
                else:
                    v = F.size(F.collect_set(c)) if stream else F.count_distinct(F.col(c))
                aggs.append(v.cast("bigint" if m.kind == "distinct" else "int").alias(m.alias))
            elif m.kind == "pairs":
                if set(m.cols) == set(dcols):
                    v = F.count(F.lit(1))
                else:
                    v = F.size(F.collect_set(F.struct(*m.cols))) if stream else F.count_distinct(F.struct(*m.cols))
                aggs.append(v.cast("int").alias(m.alias))
            elif m.kind == "first":
                aggs.append(F.min(f"_f{i}").alias(m.alias))
            elif m.kind == "last":
                aggs.append(F.max(f"_l{i}").alias(m.alias))
            else:
                raise ValueError(m.kind)
        grouped = rows.groupBy("window", r.key).agg(*aggs) if dcols else rows.select(
            "window", r.key, *[_rename_level1(m, i) for m in r.measures])
        out[r.name] = r.project(grouped)
    return out


def _rename_level1(m: Measure, i: int) -> Column:
    if m.kind == "count":
        return F.col(f"_n{i}").cast("bigint").alias(m.alias)
    if m.kind == "first":
        return F.col(f"_f{i}").alias(m.alias)
    if m.kind == "last":
        return F.col(f"_l{i}").alias(m.alias)
    raise ValueError(m.kind)


def compile_batch_all(df: DataFrame, rules: Iterable[WindowRule]) -> dict[str, DataFrame]:
    """Compile many rules; rules with equal (window, key) share level 1."""
    groups: dict[tuple, list[WindowRule]] = {}
    for r in rules:
        groups.setdefault(_family_key(r), []).append(r)
    out: dict[str, DataFrame] = {}
    for fam in groups.values():
        out.update(compile_batch_family(df, fam))
    return out


# ---------------------------------------------------------------------------
# stream
# ---------------------------------------------------------------------------

def compile_stream(df: DataFrame, rule: WindowRule, approx_distinct: bool = False) -> DataFrame:
    """Stateful form; needs a watermark on the time column upstream.

    Exact: the batch two-level plan as chained stateful aggregates.
    ``approx_distinct``: one aggregate with HyperLogLog sketches (bounded state)."""
    if not approx_distinct:
        return compile_batch_family(df, [rule], stream=True)[rule.name]
    aggs = []
    for m in rule.measures:
        if m.kind == "count":
            aggs.append(F.count(F.lit(1)).alias(m.alias))
        elif m.kind in ("distinct", "set_size"):
            if approx_distinct:
                v = F.approx_count_distinct(m.cols[0])
            else:
                v = F.size(F.collect_set(m.cols[0]))
            aggs.append(v.cast("bigint" if m.kind == "distinct" else "int").alias(m.alias))
        elif m.kind == "pairs":
            aggs.append(F.size(F.collect_set(F.struct(*m.cols))).cast("int").alias(m.alias))
        elif m.kind == "first":
            aggs.append(F.min(rule.time_col).alias(m.alias))
        elif m.kind == "last":
            aggs.append(F.max(rule.time_col).alias(m.alias))
    grouped = df.filter(rule.where()).groupBy(rule.window().alias("window"), F.col(rule.key)).agg(*aggs)
    return rule.project(grouped)
