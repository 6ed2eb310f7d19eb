"""Connected components of links between documents, by smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.tables import gathered


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)``: the smallest node reachable from each node of ``links``; nodes without links are left out.

    Every round a node takes the smallest label among its neighbours' and then the label of its label, so the rounds grow
    with the logarithm of the longest chain. Rounds are written to the shared folder.
    """
    pairs = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    edges = gathered(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "components-edges")
    labels = gathered(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "components-labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        # Written, so that the following joins have plain scans and a common label can be split.
        better = gathered(labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")), "components-near")
        jump = better.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = gathered(better.join(jump, "label", "left").select("node", F.least("label", "next").alias("label"), "old"), "components-labels")
        if not labels.where("label <> old").limit(1).count():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
