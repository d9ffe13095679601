"""Connected components as DataFrame rounds: smallest reachable id of every vertex."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.llm.storage import materialize


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> (id long, component_id long) of every vertex that has an edge.

    Each round hangs every label below the smallest label next to it, then
    follows labels twice, so a path of n vertices takes about log n rounds.
    Sums and minima are taken before the shuffle, so a vertex of very many
    edges is no hot key. Nulls and loops are dropped; no edges: no rows.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(spark, both.distinct(), "cc-edges")
    first = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("c"))
    label = materialize(spark, first, "cc-label")
    while True:
        # the smallest label next to each vertex, given to the vertex's own label
        near = both.join(label, both.b == label.id).groupBy("a").agg(F.min("c").alias("m"))
        root = label.join(near, label.id == near.a, "left").select("id", "c", F.least("c", F.coalesce("m", "c")).alias("m"))
        hook = root.groupBy("c").agg(F.min("m").alias("up"))
        step = root.join(hook, "c").select("id", F.col("c").alias("old"), F.least("m", "up").alias("c"))
        step = materialize(spark, step, "cc-step")
        jump = step.select(F.col("id").alias("c"), F.col("c").alias("j"))
        after = step.join(jump, "c", "left").select("id", "old", F.least("c", F.coalesce("j", "c")).alias("c"))
        after = materialize(spark, after, "cc-jump")
        label = after.select("id", "c")
        if after.where("old <> c").isEmpty():
            return label.select("id", F.col("c").alias("component_id"))
