"""Connected components by label propagation with pointer jumping, on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of all ends of edges (a, b); a component's name is its least id.

    Each round gives every node the least label of itself and its neighbours, then that label's
    own label, so paths shrink to a fraction. Labels are pre-aggregated before each shuffle."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("label")).withColumnRenamed("a", "id"))
    for _ in range(MAX_ROUNDS):
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        stepped = labels.join(near.withColumnRenamed("a", "id"), "id", "left").select("id", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        roots = labels.select(F.col("id").alias("label"), F.col("label").alias("root"))
        jumped = materialize(stepped.join(roots, "label", "left").select("id", F.least("label", "root").alias("label"), "was"))
        changed = jumped.filter("label <> was").limit(1).count()
        labels = jumped.drop("was")
        if not changed:
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
