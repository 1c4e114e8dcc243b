"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long) to (node, label): the smallest node that can be reached.

    Each round gives a node the smallest label among its own and its neighbours', then that
    label's own label.  Rounds grow with the logarithm of the longest path, about; every round
    is written to the shared folder, which cuts the lineage.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialise(both, "links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = step.join(jump, "label", "left").select("node", "old", F.coalesce(F.least("label", "further"), "label").alias("label"))
        step = materialise(step, "labels")
        changed = step.filter(F.col("label") != F.col("old")).count()
        labels = step.select("node", "label")
        if not changed:
            return labels
