"""Connected components of a link table by label spreading with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bookloom.llm.common import discard, materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node reachable, for every node of ``links``; nodes may be of any ordered type.

    Each round gives a node the smallest label around it and then its label's label, so rounds grow with
    the logarithm of the longest path. A node's neighbours are only ever aggregated, never gathered. Every
    round is written to the shared folder. Repeated links and links of a node to itself change nothing.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(links.select(F.col(b).alias("node"), F.col(a).alias("other")))
    both = materialise(both.dropDuplicates(), "links")
    labels = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label"))
    labels = materialise(labels, "labels")
    table = labels  # what the labels are read from
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        step = labels.join(near, "node", "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("new"))
        jump = step.select(F.col("node").alias("new"), F.col("new").alias("far"))
        step = step.join(jump, "new", "left").select("node", F.col("label").alias("old"), F.coalesce("far", "new").alias("label"))
        step = materialise(step, "labels")
        changed = step.where(F.col("old") != F.col("label")).limit(1).count()
        discard(table, collect=False)
        labels, table = step.select("node", "label"), step
        if not changed:
            discard(both, collect=False)
            return labels
