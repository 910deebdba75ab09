"""Mixing sources to target weights.  DataFrame functions only.

The words of each source, in a fixed order of its documents, are one stream, packed into blocks of
``block_words`` words.  Sources share a budget by weight; a source gives at most ``max_epochs``
times its size, and what it can't give is shared among the others by weight.  Output shards draw
multinomial source counts (every slot draws a source with the probability of its quota).  The
slots of a source, counted through all shards, run through pseudorandom permutations of its block
indexes, a new one per epoch, and blocks meet slots by an equal join on (source, block index).
Draws beyond a source's quota are left out and a last shard holds what others are short of, so
every source gets its quota to the block and no block comes more than ``max_epochs`` times.

Defined results: a null text has no words; a null source is a source of its own, the last one; rows
that repeat a doc_id are documents of their own; an empty table gives an empty result; a source
without words has target 0; columns other than the text pass unchanged.  The same rows give the
same mix, whatever their order or partitioning.

Skew: a source's prefix sums are taken in ``fan_out`` hash buckets, then over bucket sums, so a hot
source is never in one task; slots and blocks meet on (source, block), which is even by
construction.  Only counts per source and per (shard, source) go through windows by source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lansight.llm.common import WORD, bound, count_words, materialize, text_of
from lansight.session import scratch_path


@dataclass(frozen=True)
class MixRules:
    weights: tuple[int, ...] = (3, 1, 2)
    #: Words to take, as a share of all words.
    budget: float = 1.5
    max_epochs: int = 2
    block_words: int = 64
    #: Blocks of an output shard (at least; there are at most ``max_shards`` shards).
    shard_blocks: int = 4096
    max_shards: int = 100_000
    fan_out: int = 4096
    rounds: int = 12
    seed: int = 17


def source_targets(sizes: DataFrame, rules: MixRules) -> DataFrame:
    """From (src, absent, source_size): rank by code point with null last, weight and target words.

    Sources ordered by cap / weight: those capped are a prefix of that order, so one pass of running
    sums finds the level that the rest share.  One row per source goes through these windows."""
    by_name = Window.orderBy("absent", "src")
    ranked = sizes.withColumn("rank", F.row_number().over(by_name)) \
        .withColumn("weight", F.element_at(F.array(*map(F.lit, rules.weights)),
                                           ((F.col("rank") - 1) % len(rules.weights) + 1).cast("int")))
    level = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    left = ranked.withColumn("cap", F.col("source_size") * rules.max_epochs) \
        .withColumn("spare_budget", F.sum("source_size").over(everything) * F.lit(rules.budget)
                    - F.coalesce(F.sum("cap").over(before), F.lit(0))) \
        .withColumn("spare_weight", F.sum("weight").over(everything)
                    - F.coalesce(F.sum("weight").over(before), F.lit(0))) \
        .withColumn("share", F.col("spare_budget") / F.col("spare_weight")) \
        .withColumn("open", F.col("share") * F.col("weight") < F.col("cap"))
    shared = F.first(F.when(F.col("open"), F.col("share")), ignorenulls=True).over(
        level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return left.withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(
        shared * F.col("weight"), F.col("cap").cast("double")))) \
        .select("src", "absent", "rank", "source_size", "target")


def permuted(at: Column, n: Column, seed: int, rounds: int, *key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n-1 for any n: each round reflects the index about a keyed
    point if a keyed bit of the larger of the pair says so (its own inverse, so a bijection)."""
    def step(x: Column, i: Column) -> Column:
        mirrored = F.pmod(F.pmod(F.xxhash64(F.lit(seed), *key, i), n) + n - x, n)
        bit = F.xxhash64(F.lit(seed + 1), *key, i, F.greatest(x, mirrored)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, mirrored).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), at, step)


class Mix:
    """One mix of ``docs`` (doc_id, text, source and any other columns)."""

    def __init__(self, docs: DataFrame, rules: MixRules = MixRules()):
        self.rules, self.spark, self.columns = rules, docs.sparkSession, docs.columns
        self.docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).select(
            "doc", F.coalesce(F.concat(F.lit("s"), F.col("doc.source")), F.lit("n")).alias("src"),
            F.col("doc.source").isNull().alias("absent"),
            count_words(F.coalesce("doc.text", F.lit(""))).alias("size"),
            F.xxhash64(F.col("doc.text")).alias("tie")) \
            .withColumn("h", F.pmod(F.xxhash64(F.col("doc.doc_id"), F.col("tie")), F.lit(rules.fan_out)))
        here = scratch_path(self.spark, "mix")
        self.buckets = materialize(
            self.docs.groupBy("src", "absent", "h").agg(F.sum("size").alias("words")), f"{here}/buckets")
        sizes = self.buckets.groupBy("src", "absent").agg(F.sum("words").alias("source_size"))
        n = F.ceil(F.col("source_size") / rules.block_words)
        quota = F.least(n * rules.max_epochs, F.round(
            F.try_divide(F.col("target"), F.col("source_size")) * n).cast("long"))
        sources = source_targets(sizes, rules).withColumn("n_blocks", n) \
            .withColumn("quota", F.coalesce(quota, F.lit(0)))
        self.sources = materialize(
            sources.withColumn("first_slot", F.sum("quota").over(Window.orderBy("rank")) - F.col("quota")),
            f"{here}/sources")
        self.n_slots = self.sources.agg(F.sum("quota")).first()[0] or 0

    def placed(self) -> DataFrame:
        """Every document with where its words start in its source's stream."""
        inside = Window.partitionBy("src", "h").orderBy("doc.doc_id", "tie")
        across = Window.partitionBy("src").orderBy("h")
        offsets = self.buckets.withColumn("offset", F.sum("words").over(across) - F.col("words")) \
            .join(self.sources.select("src", "rank", "source_size", "target"), "src") \
            .select("src", "h", "offset", "rank", "source_size", "target")
        return self.docs.withColumn("pos", F.row_number().over(inside)) \
            .withColumn("start", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")) \
            .join(offsets, ["src", "h"]).withColumn("start", F.col("start") + F.col("offset"))

    def segments(self) -> DataFrame:
        """The parts of documents that lie in one block; a document without words has one row, block null."""
        size, start, width = F.col("size"), F.col("start"), self.rules.block_words
        blocks = F.when(size > 0, F.sequence(F.floor(start / width), F.floor((start + size - 1) / width)))
        at = F.col("block") * width
        return self.placed().withColumn("block", F.explode_outer(blocks)) \
            .withColumn("seg_from", F.greatest(start, at) - start) \
            .withColumn("seg_to", F.least(start + size, at + width) - start) \
            .withColumn("seg_words", F.coalesce(F.col("seg_to") - F.col("seg_from"), F.lit(0)))

    def shard_counts(self) -> DataFrame:
        """(shard, rank, before, kept): multinomial counts of sources per shard and the slots of the
        source in earlier shards; the last shard makes up for draws beyond the quotas."""
        rules, total = self.rules, self.n_slots
        per_shard = max(rules.shard_blocks, -(-total // rules.max_shards))
        last = -(-total // per_shard)
        width = max(1, total // 65_536)  # sources meet draws by ranges of slots: at most 65,536 + sources rows
        ranges = self.sources.where(F.col("quota") > 0).select(
            "rank", "quota", "first_slot", F.explode(F.sequence(
                F.floor(F.col("first_slot") / width),
                F.floor((F.col("first_slot") + F.col("quota") - 1) / width))).alias("part"))
        draws = self.spark.range(total).select(
            F.floor(F.col("id") / per_shard).alias("shard"),
            F.pmod(F.xxhash64(F.lit(rules.seed), F.col("id")), F.lit(max(1, total))).alias("u")) \
            .withColumn("part", F.floor(F.col("u") / width))
        drawn = draws.join(ranges, "part") \
            .where((F.col("u") >= F.col("first_slot")) & (F.col("u") < F.col("first_slot") + F.col("quota"))) \
            .groupBy("shard", "rank").agg(F.count("*").alias("n"))
        running = Window.partitionBy("rank").orderBy("shard")
        counted = drawn.join(self.sources.select("rank", "quota"), "rank") \
            .withColumn("before", F.sum("n").over(running) - F.col("n"))
        kept = counted.select("shard", "rank", "before", F.greatest(
            F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("before"))).alias("kept"))
        totals = drawn.groupBy("rank").agg(F.sum("n").alias("n"))
        short = self.sources.join(totals, "rank", "left").select(
            F.lit(last).cast("long").alias("shard"), "rank", F.coalesce("n", F.lit(0)).alias("before"),
            F.greatest(F.lit(0), F.col("quota") - F.coalesce("n", F.lit(0))).alias("kept"))
        return kept.unionByName(short).where(F.col("kept") > 0)

    def slots(self) -> DataFrame:
        """(shard, rank, slot, block): every slot with the index of its block."""
        rules = self.rules
        # a few small rows grow into many: with a number given they are not put together again before
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.n_slots // 500_000)
        return self.shard_counts().repartition(parts, "shard", "rank") \
            .withColumn("slot", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("kept") - 1))) \
            .join(self.sources.select("rank", "n_blocks"), "rank") \
            .select("shard", "rank", "slot", permuted(
                F.col("slot") % F.col("n_blocks"), F.col("n_blocks"), rules.seed, rules.rounds,
                F.col("rank"), F.floor(F.col("slot") / F.col("n_blocks"))).alias("block"))

    def mixed(self) -> DataFrame:
        """The mix: a row per slot and part of a document in its block, with the document's columns (the
        text is that part, white space after its words included), shard, slot and source rank."""
        width, size, start = self.rules.block_words, F.col("size"), F.col("start")
        tokens = F.regexp_extract_all(F.coalesce("doc.text", F.lit("")), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
        blocks = F.sequence(F.floor(start / width), F.floor((start + size - 1) / width))

        def part(words: Column, block: Column) -> Column:
            low = F.greatest(start, block * width) - start
            n = F.least(start + size, block * width + width) - start - low
            text = F.array_join(F.slice(words, (low + 1).cast("int"), n.cast("int")), "")
            return F.struct(block.alias("block"), n.alias("seg_words"), text.alias("part"))

        # a text falls apart into words once, whatever the number of its blocks, and only parts leave the row
        rest = F.struct(F.col("rank").alias("_rank"), start.alias("_start"), *[F.col(f"doc.`{c}`") for c in self.columns if c != "text"])
        rows = self.placed().where(size > 0).select(
            rest.alias("rest"), bound(tokens, lambda words: F.transform(blocks, lambda x: part(words, x))).alias("parts")) \
            .select("rest", F.explode("parts").alias("x"))
        parts = rows.select(
            F.col("rest._rank").alias("rank"), F.col("x.block").alias("block"), F.col("rest._start").alias("start"),
            F.col("x.seg_words").alias("seg_words"),
            F.struct(*[F.col("x.part").alias(c) if c == "text" else F.col(f"rest.`{c}`") for c in self.columns]).alias("doc"))
        return parts.join(self.slots(), ["rank", "block"]).select(
            "doc", F.struct("shard", "rank", "slot", "start", "seg_words").alias("mix"))

    def usage(self) -> DataFrame:
        """Every document with the words the mix takes of it (repeats counted)."""
        times = self.slots().groupBy("rank", "block").agg(F.count("*").alias("times"))
        return self.segments().select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "rank",
                                      "h", "pos", "block", "seg_words") \
            .join(times, ["rank", "block"], "left") \
            .groupBy("rank", "h", "pos").agg(
                F.first("doc_id").alias("doc_id"), F.first("size").alias("size"),
                F.first("source_size").alias("source_size"), F.first("target").alias("target"),
                F.sum(F.col("seg_words") * F.coalesce("times", F.lit(0))).alias("taken")) \
            .select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """The mix with the columns of ``docs``: n_chars follows the text where there is such a column."""
    mixed = Mix(docs, rules).mixed()
    return mixed.select(*[F.length("doc.text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
                          else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def op2_mixing(docs: DataFrame) -> DataFrame:
    return Mix(docs.select("doc_id", "text", "source")).usage()
