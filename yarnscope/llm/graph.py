"""Connected components of an edge table, for graphs of any size.

Every round each node takes the smallest label among itself and its
neighbours, then the label of its label (pointer jumping), so the number of
rounds grows with the logarithm of the longest path. Labels are written to
the shared checkpoint folder every round: lineage stays one round long and a
lost executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yarnscope.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``: label = least node reachable.

    Nodes without an edge are not listed. Self loops and repeated edges do no harm.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")) \
        .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))) \
        .where(F.col("node") != F.col("other")).distinct()
    both = materialize(both, "edges")
    labels = materialize(both.groupBy("node").agg(F.min("other").alias("least"))
                         .select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("seen")), "other") \
            .groupBy("node").agg(F.min("seen").alias("seen"))
        step = labels.join(near, "node", "left") \
            .select("node", F.col("label").alias("was"), F.least("label", "seen").alias("label"))
        # pointer jumping: a label is itself a node, follow it once
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = step.join(jump, "label", "left") \
            .select("node", "was", F.least("label", "next").alias("label"))
        step = materialize(step, "labels")
        changed = step.where(F.col("was") != F.col("label")).limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels
