"""Sharding by weighted rendezvous hashing of stable record keys.

Every (key, shard) pair draws a number u in (0, 1) from a hash, and a record goes to the shard of the
smallest ``-ln(u) / weight``.  A shard so wins a share of the keys in proportion to its weight, and a
key's choice depends on nothing but the key and the shards: one more shard takes exactly the keys it
wins and moves no other record.

Slots number a shard's rows from 0 without gaps, in the order of key, checksum and size.  The rows are
range-partitioned and sorted by (shard, that order), written, and numbered by their place in the
written files: a row's slot is the number of the shard's rows in earlier files plus its own place in
its file.  So no task holds a shard, and a key that a third of all rows share is cut by a salt into as
many tasks as its size asks for (rows that differ in the salt alone are equal, so it doesn't show).

Defined results: a null key is hashed as the empty text and comes first; a null text has no bytes
(checksum 0); repeated rows share a shard and have slots of their own; an empty table gives an empty
result; columns other than the added ones pass unchanged (an added one replaces a column of its name).
The cost grows with records x shards: one md5 a pair.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lansight.llm.common import materialize, text_of, within
from lansight.session import scratch_path

#: Hexadecimal digits of the hash that are drawn from: 52 bits, which a double holds exactly.
DIGITS = 13
#: Rows of the table of file offsets (one per file and shard met in it) up to which it is broadcast.
BROADCAST_OFFSETS = 500_000


@dataclass(frozen=True)
class ShardRules:
    #: One weight per shard; a weight of 0 closes a shard.
    weights: tuple[float, ...] = (1.0,) * 40
    #: Weight of the shard that ``grown`` adds.
    next_weight: float = 1.0
    #: Bytes that a record takes besides its text.
    overhead: int = 16


def draw(key: Column, shard: Column) -> Column:
    """-ln(u) of a (key, shard) pair."""
    told = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), shard.cast("string")).cast("binary"))
    return -F.log((F.conv(F.substring(told, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** DIGITS))


def best_of(key: Column, weights: tuple[float, ...]) -> Column:
    """struct(score, shard) of the shard that wins the key; ties go to the smaller shard."""
    shards = [s for s, w in enumerate(weights) if w > 0]
    if not shards:
        raise ValueError("no shard has a weight above 0")
    return F.array_min(F.transform(
        F.array(*[F.struct(F.lit(s).alias("s"), F.lit(float(weights[s])).alias("w")) for s in shards]),
        lambda x: F.struct((draw(key, x["s"]) / x["w"]).alias("score"), x["s"].alias("shard"))))


def assign(docs: DataFrame, rules: ShardRules = ShardRules(), key: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard``, and ``grown_shard`` if there were one more."""
    fresh = len(rules.weights)
    out = docs.withColumn("shard", best_of(F.col(key), rules.weights))
    moves = draw(F.col(key), F.lit(fresh)) / rules.next_weight < F.col("shard.score") if rules.next_weight > 0 else F.lit(False)
    return out.withColumn("grown_shard", F.when(moves, F.lit(fresh)).otherwise(F.col("shard.shard"))) \
        .withColumn("shard", F.col("shard.shard"))


def number_slots(rows: DataFrame, path: str, order: list[str]) -> DataFrame:
    """``rows`` (with ``shard``) written to ``path`` in the order of shard and ``order``, and returned with ``slot``."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ["shard", *order, "_salt"]
    written = materialize(rows.withColumn("_salt", F.monotonically_increasing_id())
                          .repartitionByRange(tasks, *by).sortWithinPartitions(*by).drop("_salt"), path)
    placed = written.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    number = F.regexp_extract("_file", r"part-(\d+)", 1).cast("long")
    before = Window.partitionBy("shard").orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        placed.groupBy("shard", "_file").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), f"{path}-offsets")
    if within(offsets, BROADCAST_OFFSETS):
        offsets = F.broadcast(offsets)
    return placed.join(offsets, ["shard", "_file"]).select(
        *[F.col(f"`{c}`") for c in rows.columns if c != "slot"],
        (F.col("_offset") + F.col("_row") - F.col("_first")).alias("slot"))


def shard_documents(docs: DataFrame, path: str, rules: ShardRules = ShardRules(), key: str = "doc_id") -> DataFrame:
    """Whole documents placed and numbered; ``path`` holds them as Parquet, sorted by shard, so that a
    reader of one shard skips the row groups of the others."""
    text = text_of().cast("binary")
    placed = assign(docs.withColumn("size", F.octet_length(text).cast("long") + rules.overhead)
                    .withColumn("text_crc32", F.crc32(text)), rules, key)
    return number_slots(placed, path, [key, "text_crc32", "size"])


def op12_sharding(docs: DataFrame) -> DataFrame:
    """Only the digest columns go through the shuffle: the texts stay where they are."""
    rules = ShardRules()
    text, here = text_of().cast("binary"), scratch_path(docs.sparkSession, "shards")
    slim = docs.select("doc_id", (F.octet_length(text).cast("long") + rules.overhead).alias("size"),
                       F.crc32(text).alias("text_crc32"))
    # written first: range partitioning reads its input twice, and this reads the texts once
    slim = materialize(assign(slim, rules), f"{here}/assigned")
    placed = number_slots(slim, f"{here}/placed", ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
