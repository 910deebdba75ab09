"""Personal data by candidate gradient boosting.  DataFrame functions only.

Base rules find e-mail addresses, IP addresses, payment cards and phone numbers by pattern and
check; their spans always stay.  High-recall generators propose further, overlapping spans
(bracketed e-mails, loose digit groups, long numbers, dotted quads).  Boosted trees score
candidates by format and context: sizes, digit groups, separators, neighbouring characters and
words before.  The trees are fitted on the candidates of all documents: those of equal features are counted
once, and every level of a tree is one aggregate over the counts.  Positive ones meet a base
span of their kind, or are base phone numbers with plus sign and country code masked; negative ones meet
another kind's base span, fail their kind's check, or stand in code.  Other candidates tell nothing and
are left out of the fit (the features leave out what the base checks test, such as the leading plus sign,
the Luhn sum and the 255 limit).  Per kind the score threshold is the lowest that keeps ``precision`` on
the half of the documents that the trees did not see.  Candidates above it that meet no base span, of a
format that ``min_positive`` positives have, are added.  Trees become CASE expressions, so scoring is
plain SQL.

Positions come from splitting a text at a pattern: lengths of the parts and of the matches between
add up to code-point offsets.  The patterns are rewritten so that no repeated group remains (those
recurse per repetition) and runs are entered at their start only, which keeps them linear in texts of any
length; ``tests`` hold them against the plain patterns.

Defined results: a null text is empty and has no spans; repeated rows and null ids are scanned row
by row; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lansight.llm.common import lower_ascii, materialize, text_of
from lansight.session import scratch_path

KINDS = ("email", "ip", "card", "phone")
SPAN = "struct<start:int,end:int,found:string>"


@dataclass(frozen=True)
class PiiRules:
    trees: int = 12
    shrinkage: float = 0.4
    min_positive: int = 10
    precision: float = 0.99
    context: int = 24


def matches(text: Column, pattern: str, gate: Column) -> Column:
    """The pattern's leftmost non-overlapping matches where ``gate`` holds: (start, end, found), in code points."""
    found, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    empty = F.array().cast(f"array<{SPAN}>")

    def put(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["part"])
        end = start + F.length(pair["found"])
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(F.struct(
            start.alias("start"), end.alias("end"), pair["found"].alias("found")))).alias("spans"))

    pairs = F.zip_with(F.slice(parts, 1, F.size(found)), found,
                       lambda p, f: F.struct(p.alias("part"), f.alias("found")))
    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("spans")), put, lambda d: d["spans"])
    return F.when(gate, spans).otherwise(empty)


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def email_matches(text: Column) -> Column:
    # a dot that is no label's end and another's start can't part labels: it stays in the local part's
    # alphabet but leaves the domain's
    inner = F.regexp_replace(text, r"\.(?![A-Za-z0-9-])|(?<![A-Za-z0-9-])\.", "_")
    own = r"A-Za-z0-9._%+-"
    return matches(inner, rf"(?:(?<![{own}])|\G)[{own}]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]+", F.contains(text, F.lit("@")))


def ip_matches(text: Column) -> Column:
    return matches(text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+", text.rlike(r"[0-9]\.[0-9]"))


def card_matches(text: Column, at_least: int = 14) -> Column:
    # a separator that isn't single and between digits ends a number
    joined = F.regexp_replace(text, "[ -](?![0-9])|(?<![0-9])[ -]", "x")
    return matches(joined, "[0-9][0-9 -]*[0-9]", text.rlike(f"[0-9](?:[ -]?[0-9]){{{at_least - 1}}}"))


def phone_matches(text: Column) -> Column:
    return matches(text, r"\+[0-9][ ().0-9-]+[0-9]", F.contains(text, F.lit("+")))


def valid_ip(found: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(found, r"\."), lambda p: (F.length(part(p)) <= 3)
                    & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))


def valid_card(found: Column) -> Column:
    d = digits_of(found)

    def add(total: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int") * (i % 2 + 1)
        return total + x - F.when(x > 9, 9).otherwise(0)

    return F.length(d).between(14, 19) & (F.aggregate(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.least(F.length(d) - 1, F.lit(18)))), F.lit(0), add) % 10 == 0)


def valid_phone(found: Column) -> Column:
    return F.length(digits_of(found)).between(10, 15)


def base_spans(text: Column) -> list[Column]:
    """Per kind the matches that pass their check; a failing match is dropped without a retry."""
    return [email_matches(text), F.filter(ip_matches(text), lambda s: valid_ip(s["found"])),
            F.filter(card_matches(text), lambda s: valid_card(s["found"])),
            F.filter(phone_matches(text), lambda s: valid_phone(s["found"]))]


def proposed_spans(text: Column) -> list[Column]:
    """Per kind generous candidates, which may overlap each other and base spans."""
    bracketed = F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]"))
    return [
        F.concat(email_matches(text), matches(
            text, r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?[(\[]dot[)\]] ?|\.)"
                  r"[A-Za-z][A-Za-z0-9.-]+", bracketed)),
        ip_matches(text),
        F.filter(card_matches(text, 12), lambda s: F.length(digits_of(s["found"])).between(12, 19)),
        F.filter(matches(text, r"(?<![0-9])[0-9(][0-9(). -]{5,24}[0-9](?![0-9])", text.rlike("[0-9]{3}[). -]")),
                 lambda s: F.length(digits_of(s["found"])).between(7, 15)),
    ]


CONTEXT_WORDS = (  # fixed values: words before a span that tell its kind
    ("says_mail", "mail|contact|write"), ("says_ip", "ip|host|server|address"),
    ("says_card", "card|visa|credit|account|pay"), ("says_phone", "phone|call|tel|fax|mobil"),
    ("says_code", "token|key|secret|version|id"))
FEATURES = ("kind", "size", "digits", "groups", "longest", "dots", "spaces", "dashes", "brackets", "letters",
            "joined_before", "joined_after", "lines_up", *[n for n, _ in CONTEXT_WORDS])


def candidate(text: Column, span: Column, kind: int, rules: PiiRules) -> Column:
    """A candidate's features, all small integers."""
    found = span["found"]
    less = lambda chars: F.length(found) - F.length(F.translate(found, chars, ""))
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: F.length(g) > 0)
    room = F.greatest(F.lit(0), span["start"] - rules.context)
    before = lower_ascii(F.substring(text, room + 1, span["start"] - room))
    near = lambda at: F.substring(text, at, F.lit(1))
    values = [
        F.lit(kind), F.least(F.length(found), F.lit(60)), F.length(digits_of(found)), F.size(groups),
        F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), less("."), less(" "), less("-"), less("()[]"),
        F.length(F.regexp_replace(found, "[^A-Za-z]", "")),
        F.when(span["start"] > 0, near(span["start"]).rlike("[A-Za-z0-9_]")).otherwise(False).cast("int"),
        near(span["end"] + 1).rlike("[A-Za-z0-9_]").cast("int"),
        F.size(F.array_distinct(F.transform(groups, F.length))),
        *[before.rlike(f"(?:{words})").cast("int") for _, words in CONTEXT_WORDS]]
    return F.struct(span["start"].alias("start"), span["end"].alias("end"),
                    *[v.cast("int").alias(n) for n, v in zip(FEATURES, values)])


def meets(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


FORMAT = ("kind", "digits", "groups", "longest", "dots", "spaces", "dashes", "brackets", "letters")


def masked_phone(span: Column) -> Column:
    """A phone number without the mark that the base rule needs: its plus sign and country code."""
    mark = F.regexp_extract(span["found"], r"^\+[0-9]{1,3}[ .-]+(?=[0-9(])", 0)
    size = F.greatest(F.length(mark), F.lit(1))
    return F.struct((span["start"] + size).alias("start"), span["end"].alias("end"),
                    F.substring(span["found"], size + 1, F.length(span["found"])).alias("found"))


def told(c: Column, base: Column) -> Column:
    """1: meets a base span of its kind.  0: meets another kind's, fails its kind's check (addresses and cards that
    meet no base span), or stands in code.  Null: no base match, which tells nothing."""
    of_kind = F.filter(base, lambda o: o["kind"] == c["kind"])
    in_code = (c["kind"] == 3) & ((c["joined_before"] + c["joined_after"] + c["says_code"]) > 0)
    return F.when(meets(c, of_kind), 1).when(meets(c, base) | c["kind"].isin(1, 2) | in_code, 0)


def with_spans(docs: DataFrame, rules: PiiRules) -> DataFrame:
    """``docs`` (doc_id, text) with ``base`` (sorted start, kind, end) and ``candidates`` that carry
    features, ``positive`` (meets a base span) and ``label``, and ``masked``, the phone numbers without their mark."""
    text = F.col("text")
    order = lambda spans, k: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))
    described = lambda spans, k: F.transform(spans, lambda s: candidate(text, s, k, rules))
    found = docs.select("doc_id", text_of().alias("text")) \
        .withColumn("per_kind", F.array(*base_spans(text))).withColumn("proposed", F.array(*proposed_spans(text)))
    return found.withColumn("base", F.sort_array(F.concat(*[order(F.col("per_kind")[k], k) for k in range(len(KINDS))]))) \
        .withColumn("candidates", F.concat(
            *[described(F.col("proposed")[k], k) for k in range(len(KINDS))])) \
        .withColumn("candidates", F.transform("candidates", lambda c: F.struct(
            c.alias("c"), meets(c, F.col("base")).alias("positive"), told(c, F.col("base")).alias("label")))) \
        .withColumn("masked", F.transform(
            described(F.filter(F.transform(F.col("per_kind")[3], masked_phone),
                               lambda s: F.length(digits_of(s["found"])).between(7, 15)), 3),
            lambda c: F.struct(c.alias("c"), F.lit(True).alias("positive"), F.lit(1).alias("label"))))


# --- boosted trees ----------------------------------------------------------------------------

UNIT = 1 << 24  # fixed value: gradients are summed as whole numbers of this fraction, so in any order alike
DEPTH = 3


def place(splits: dict, path: str = "") -> Column:
    """The node of a growing tree that a row falls into, as its path of l (low) and h (high)."""
    if path not in splits:
        return F.lit(path)
    k, limit = splits[path]
    return F.when(F.col(FEATURES[k]) <= limit, place(splits, path + "l")).otherwise(place(splits, path + "h"))


def best_splits(rows: DataFrame, node: Column, depth: int) -> list:
    """A row per node of that depth: its sums, and the feature and limit of largest gain (ties: the first
    feature, the smallest limit) with the sums of the low side."""
    cells = rows.withColumn("node", node).where(F.length("node") == depth).select(
        "node", "g", "h", F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), F.col(n).alias("value")) for k, n in enumerate(FEATURES)])).alias("x")) \
        .groupBy("node", "x.k", "x.value").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    feature = Window.partitionBy("node", "k")
    so_far = feature.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    real = lambda x: x / F.lit(float(UNIT))
    sums = cells.select(
        "node", "k", "value", real(F.sum("g").over(so_far)).alias("low_g"), real(F.sum("h").over(so_far)).alias("low_h"),
        real(F.sum("g").over(feature)).alias("all_g"), real(F.sum("h").over(feature)).alias("all_h"),
        (F.col("value") == F.max("value").over(feature)).alias("last"))
    part = lambda g, h: g * g / (h + 1.0)
    g, h, low_g, low_h = map(F.col, ("all_g", "all_h", "low_g", "low_h"))
    gain = F.when(F.col("last"), F.lit(-1.0)).otherwise(part(low_g, low_h) + part(g - low_g, h - low_h) - part(g, h))
    return sums.withColumn("gain", gain).groupBy("node").agg(F.max_by(
        F.struct("gain", "k", "value", "low_g", "low_h", "all_g", "all_h"),
        F.struct("gain", -F.col("k"), -F.col("value"))).alias("best")).select("node", "best.*").collect()  # at most 8 rows


def grow(rows: DataFrame):
    """A regression tree on integer columns, from rows with gradients ``g`` and ``h``: nested (feature, limit, low
    branch, high branch) or a leaf value."""
    splits, leaves = {}, {}
    leaf = lambda g, h: float(-g / (h + 1.0))
    for depth in range(DEPTH):
        found = best_splits(rows, place(splits), depth)
        for r in found:
            leaves[r.node] = leaf(r.all_g, r.all_h)
            if r.gain > 1e-3:
                splits[r.node] = (r.k, int(r.value))
                leaves[r.node + "l"] = leaf(r.low_g, r.low_h)
                leaves[r.node + "h"] = leaf(r.all_g - r.low_g, r.all_h - r.low_h)
        if not any(r.node in splits for r in found):
            break

    def nested(path: str):
        return (*splits[path], nested(path + "l"), nested(path + "h")) if path in splits else leaves[path]

    return nested("")


def expression(tree, c: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(tree)
    return F.when(c[FEATURES[tree[0]]] <= tree[1], expression(tree[2], c)).otherwise(expression(tree[3], c))


def margin(trees: list, c, rules: PiiRules) -> Column:
    return reduce(lambda a, b: a + b, (rules.shrinkage * expression(t, c) for t in trees), F.lit(0.0))


def fit_trees(cases, rules: PiiRules):
    """(trees, threshold per kind) from a table (features..., half, negatives ``neg``, positives ``pos``), whose
    sums come back, never its rows; no table or an empty one gives no trees."""
    if not isinstance(cases, DataFrame) or cases.isEmpty():
        return [], [None] * len(KINDS)
    fit, trees, every = cases.where("half = 0"), [], F.col("neg") + F.col("pos")
    columns = {n: F.col(n) for n in FEATURES}
    for _ in range(0 if fit.isEmpty() else rules.trees):
        p = 1.0 / (1.0 + F.exp(-margin(trees, columns, rules)))
        whole = lambda x: F.round(x * (rules.shrinkage * UNIT)).cast("long")
        trees.append(grow(fit.withColumn("p", p).select(
            *FEATURES, whole(every * F.col("p") - F.col("pos")).alias("g"),
            whole(every * F.col("p") * (1.0 - F.col("p"))).alias("h"))))
    # per kind from the highest margin down, as long as the precision holds
    down = Window.partitionBy("kind").orderBy(F.desc("margin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = cases.where("half <> 0").select("kind", F.round(margin(trees, columns, rules), 9).alias("margin"), "neg", "pos") \
        .groupBy("kind", "margin").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")) \
        .select("kind", "margin", F.sum("pos").over(down).alias("good"), F.sum("neg").over(down).alias("bad"))
    short = F.col("good") < rules.precision * (F.col("good") + F.col("bad"))
    chosen = held.withColumn("short", F.max(short).over(down)).where(~F.col("short") & (F.col("good") >= rules.min_positive)) \
        .groupBy("kind").agg(F.min("margin").alias("margin")).collect()  # at most a row per kind
    limits = {r.kind: r.margin - 1e-6 for r in chosen}
    return trees, [limits.get(k) for k in range(len(KINDS))]


def train(docs: DataFrame, rules: PiiRules):
    """Trees, thresholds and the formats of positives, from the candidates of all documents."""
    cases = with_spans(docs, rules).select(
        F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)).alias("half"), F.explode(F.concat("candidates", "masked")).alias("x"))
    counted = cases.groupBy(*[F.col(f"x.c.{n}").alias(n) for n in FEATURES], "half").agg(
        F.sum(F.when(F.col("x.label") == 0, 1).otherwise(0)).alias("neg"),
        F.sum(F.when(F.col("x.label") == 1, 1).otherwise(0)).alias("pos"),
        F.sum((~F.col("x.positive")).cast("int")).alias("asking"))
    spark = docs.sparkSession
    counted = materialize(counted, scratch_path(spark, "pii-cases"))
    trees, limits = fit_trees(counted.where("neg + pos > 0"), rules)
    # only the formats that some candidate without a base span has decide anything
    usual = counted.groupBy(*FORMAT).agg(F.sum("pos").alias("pos"), F.sum("asking").alias("asking")) \
        .where((F.col("pos") >= rules.min_positive) & (F.col("asking") > 0)).select(*FORMAT)
    return trees, limits, sorted(tuple(r) for r in usual.collect())


def find_spans(docs: DataFrame, rules: PiiRules = PiiRules()) -> DataFrame:
    """(doc_id, text, base, added): arrays of (start, kind number, end) by start and kind."""
    trees, limits, formats = train(docs, rules)
    found = with_spans(docs, rules)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    formats = [f for f in formats if limits[f[0]] is not None]
    if not trees or not formats:
        return found.select("doc_id", "text", "base", none.alias("added"))
    score = lambda c: margin(trees, c, rules)
    limit = lambda c: reduce(
        lambda out, k: F.when(c["kind"] == k, F.lit(limits[k])).otherwise(out),
        [k for k in range(len(KINDS)) if limits[k] is not None], F.lit(float("inf")))
    usual = lambda c: F.concat_ws(" ", *[c[n].cast("string") for n in FORMAT]).isin(
        [" ".join(map(str, f)) for f in formats])
    added = F.transform(F.filter("candidates", lambda x: ~x["positive"] & usual(x["c"]) & (score(x["c"]) >= limit(x["c"]))),
                        lambda x: F.struct(x["c"]["start"].alias("start"), x["c"]["kind"].alias("kind"),
                                           x["c"]["end"].alias("end")))
    return found.select("doc_id", "text", "base", F.sort_array(F.array_distinct(added)).alias("added"))


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, rules: PiiRules = PiiRules()) -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in brackets; of overlapping spans the first one
    (by start, then kind) names the place and covers the others' ends."""
    names = F.array(*map(F.lit, KINDS))

    def put(done: Column, s: Column) -> Column:
        new = s["start"] >= done["at"]
        kept = F.substring(F.col("text"), done["at"] + 1, s["start"] - done["at"])
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(new, F.concat(done["out"], kept, F.lit("["), F.element_at(names, s["kind"] + 1), F.lit("]")))
            .otherwise(done["out"]).alias("out"))

    spans = F.sort_array(F.concat("base", "added"))
    out = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put)
    return find_spans(docs, rules).withColumn("o", out).select(
        "doc_id", F.concat("o.out", F.substring(F.col("text"), F.col("o.at") + 1, F.length("text"))).alias("text"))


def op6_pii(docs: DataFrame) -> DataFrame:
    found = find_spans(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{n}") for k, n in enumerate(KINDS)],
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.sort_array(F.concat("base", "added"))).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))
