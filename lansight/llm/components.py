"""Connected components of an edge table, without gathering edges or labels anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lansight.llm.common import materialize
from lansight.session import scratch_path


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rows_per_task: int = 200_000) -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Alternating large-star and small-star steps: every node hands its larger neighbours, then its
    smaller ones, to the smallest node it knows, until the edges are stars.  Rounds grow with the
    logarithm of the longest path; each is written to the shared folder, so lineage stays short.
    The minimum per node is a map-side sum, so a hub costs a row per task there.  Small edge tables
    run in few tasks (``rows_per_task``): a round has several shuffles, and empty tasks would be
    most of its time."""
    spark = edges.sparkSession
    here = scratch_path(spark, "components")
    now = materialize(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), f"{here}/0")
    step, before = 0, None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, step = state, step + 1
        tasks = 4 + 4 * state[0] // rows_per_task
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(tasks)
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where(F.col("u") != F.col("v")).coalesce(tasks).distinct().coalesce(tasks),
                            f"{here}/{step}-large")
        low = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.withColumnRenamed("m", "v"))
        now = materialize(small.where(F.col("u") != F.col("v")).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).coalesce(tasks).distinct().coalesce(tasks),
            f"{here}/{step}")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
