"""Line dedup over levelled sorted runs.

The state is a set of *runs*: bucketed tables sorted by line hash, one row per hash with the number
of documents seen (``n_docs``) and the largest id among them (``max_doc``).  A new batch of
documents aggregates its own lines, merge-anti-joins the runs (lines whose fate a run already
settles: enough documents there, and one with a larger id), and adds the rest as a run of level 0.
When a level holds ``fanout`` runs they are merged into one of the next level, so a hash is
rewritten a logarithmic number of times.  Counts add up over runs, so batches may come in any
order as long as a document id is in one batch only; a table is taken from its largest ids
downwards, so that a line which the first batches settle is never written again.

A line's key is the line without white space at its ends and with A-Z lower-cased, held as a
128-bit hash.  Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents
keep their lines only in the largest document id that holds them.

Defined results: a null or empty text is one empty line; rows that repeat a doc_id are one
document when documents are counted; a null doc_id counts as one document that is smaller than all
others; an empty table gives an empty result; columns other than the text pass unchanged.

Scale: the texts are read twice, once for their lines' hashes (written, 24 bytes a line) and once to
leave lines out.  Lines are counted by hash with map-side sums, so a line found in every document costs
one row a task.  A text's lost lines are gathered as positions and taken out by a hashed set
difference, in time linear in its lines.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lansight.llm.common import SPACES, lower_ascii, materialize, text_of
from lansight.session import remove_path, scratch_path

#: Stands in for a null doc_id: smaller than every id.
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class LineRules:
    min_chars: int = 20
    min_docs: int = 3
    #: Batches; None takes one per ``batch_lines`` lines, three at least.
    batches: int | None = None
    batch_lines: int = 200_000_000
    fanout: int = 2
    #: Buckets of a run; None takes the session's shuffle partitions.
    buckets: int | None = None


def line_key(line: Column) -> Column:
    return F.btrim(lower_ascii(line), F.lit(SPACES))


def key_hashes(key: Column) -> tuple[Column, Column]:
    """128 bits of a key, as two longs."""
    return F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key, F.lit("b")).alias("h2")


def line_hashes(docs: DataFrame, rules: LineRules) -> DataFrame:
    """(doc, text_key, pos, h1, h2) of every line whose key is long enough."""
    text = text_of()
    # the text's hash is taken below the explode, once a text and not once a line
    parted = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                         F.xxhash64(text).alias("text_key"), F.split(text, "\n").alias("lines"))
    lines = parted.select("doc", "text_key", F.posexplode("lines").alias("pos", "line")) \
        .where(F.length("line") >= rules.min_chars) \
        .select("doc", "text_key", "pos", line_key(F.col("line")).alias("key")) \
        .where(F.length("key") >= rules.min_chars)
    return lines.select("doc", "text_key", "pos", *key_hashes(F.col("key")))


class LineRuns:
    """Levelled runs of line hashes: bucketed tables whose files lie in the shared folder."""

    def __init__(self, spark: SparkSession, rules: LineRules = LineRules()):
        self.spark, self.rules = spark, rules
        self.buckets = rules.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, list[str]] = {}
        self.here = scratch_path(spark, "line-runs")

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex[:16]}"
        self.levels.setdefault(level, []).append(name)
        rows.repartition(self.buckets, "h1", "h2").write.mode("overwrite").format("parquet") \
            .option("path", f"{self.here}/{name}") \
            .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name)

    def _forget(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_path(self.spark, f"{self.here}/{name}")

    def _runs(self) -> list[str]:
        return [n for _, names in sorted(self.levels.items()) for n in names]

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs folded pairwise by full outer merge joins: equal buckets meet without a shuffle."""
        rows = self.spark.table(names[0])
        for n in names[1:]:
            a, b = rows.alias("a"), self.spark.table(n).alias("b")
            same = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2"))
            rows = a.join(b.hint("merge"), same, "full_outer").select(
                F.coalesce("a.h1", "b.h1").alias("h1"), F.coalesce("a.h2", "b.h2").alias("h2"),
                (F.coalesce("a.n_docs", F.lit(0)) + F.coalesce("b.n_docs", F.lit(0))).alias("n_docs"),
                F.greatest("a.max_doc", "b.max_doc").alias("max_doc"))
        return rows

    def add(self, hashes: DataFrame) -> None:
        """Take in a batch's line hashes (of documents that no earlier batch held)."""
        own = hashes.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one")) \
            .groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc").alias("max_doc"))
        for name in self._runs():
            run = self.spark.table(name).where(F.col("n_docs") >= self.rules.min_docs).alias("run")
            own = own.alias("own").join(
                run, (F.col("own.h1") == F.col("run.h1")) & (F.col("own.h2") == F.col("run.h2"))
                & (F.col("run.max_doc") >= F.col("own.max_doc")), "left_anti")
        self._write(own, 0)
        level = 0
        while len(self.levels.get(level, [])) >= self.rules.fanout:
            self.compact(level)
            level += 1

    def compact(self, level: int) -> None:
        names = self.levels[level]
        self._write(self._merged(names), level + 1)
        del self.levels[level]
        for n in names:
            self._forget(n)

    def repeated(self) -> DataFrame:
        """(h1, h2, max_doc) of the keys found in enough documents."""
        return self._merged(self._runs()).where(F.col("n_docs") >= self.rules.min_docs).select("h1", "h2", "max_doc")

    def drop(self) -> None:
        for n in self._runs():
            self._forget(n)
        self.levels = {}


def batch_of(hashes: DataFrame, rules: LineRules) -> DataFrame:
    """``hashes`` with ``batch``: ranges of doc with about as many lines each, the largest ids first."""
    n = rules.batches
    if n is None:
        n = max(3, -(-hashes.count() // rules.batch_lines))
    cuts = hashes.select(F.percentile_approx("doc", [i / n for i in range(1, n)], 1000)).first()[0] if n > 1 else None
    cuts = sorted(set(cuts or []))
    below = sum((F.when(F.col("doc") < c, 1).otherwise(0) for c in cuts), F.lit(0))
    return hashes.withColumn("batch", below)


def lost_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """(doc, text_key, lost): the positions of the lines that each text loses."""
    spark = docs.sparkSession
    here = scratch_path(spark, "line-hashes")
    whole = materialize(line_hashes(docs.select("doc_id", "text"), rules), f"{here}/lines")
    runs = LineRuns(spark, rules)
    try:
        parts = batch_of(whole, rules)
        for i in range(parts.agg(F.max("batch")).first()[0] + 1 if whole.head(1) else 1):
            runs.add(parts.where(F.col("batch") == i))
        repeated = materialize(runs.repeated(), f"{here}/repeated")
    finally:
        runs.drop()
    lost = whole.join(repeated, ["h1", "h2"]).where(F.col("doc") < F.col("max_doc")) \
        .groupBy("doc", "text_key", "pos").agg(F.lit(1).alias("one")) \
        .groupBy("doc", "text_key").agg(F.collect_list("pos").alias("lost"))
    lost = materialize(lost, f"{here}/lost")
    for step in ("lines", "repeated"):
        remove_path(spark, f"{here}/{step}")
    return lost


def dedup_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text``, and a struct ``lines`` with n_lines (before)
    and n_dropped.  Columns other than ``text`` pass unchanged."""
    lost = lost_lines(docs, rules).select(F.col("doc").alias("_doc"), F.col("text_key").alias("_key"), F.col("lost").alias("_lost"))
    lines = F.split(text_of(), "\n")
    joined = docs.join(lost, (F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("_doc"))
                       & (F.xxhash64(text_of()) == F.col("_key")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_lost"))
    kept = F.when(F.col("_doc").isNull(), text_of()).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n"))
    return joined.withColumn("_lines", lines).select(
        *[kept.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.struct(F.size("_lines").cast("long").alias("n_lines"),
                 F.coalesce(F.size(F.col("_lost")), F.lit(0)).cast("long").alias("n_dropped")).alias("lines"))


def op4_line_dedup(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", F.col("lines.n_lines").alias("n_lines"), F.col("lines.n_dropped").alias("n_dropped"),
        F.sha2(F.col("text"), 256).alias("kept_sha256"))
