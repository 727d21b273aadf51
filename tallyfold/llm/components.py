"""Connected components of a link table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.session import discard, materialise


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of a link; root is the smallest node of its component.

    Each round every node takes the smallest label among its neighbours and its
    own, and then the label of its label, so that long chains halve. Rounds go
    on until none changes; each one's labels are a stored table.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = materialise(both.union(both.select("other", "node")).where("node != other").distinct(), "links")
    labels = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root"))
    labels = old = materialise(labels, "labels")
    while True:
        reached = both.join(labels.select(F.col("node").alias("other"), F.col("root").alias("near")), "other")
        reached = reached.groupBy("node").agg(F.min("near").alias("near"))
        step = labels.join(reached, "node").select("node", "root", F.least("root", "near").alias("label"))
        far = labels.select(F.col("node").alias("label"), F.col("root").alias("far"))
        step = step.join(far, "label", "left")
        step = step.select("node", F.least("label", F.coalesce("far", "label")).alias("root"), F.col("root").alias("was"))
        step = materialise(step, "labels")
        discard(old)
        labels, old = step.select("node", "root"), step
        if step.where("root != was").isEmpty():
            discard(both)
            return labels
