"""Connected components of links, as rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabvitals.llm.common import in_few_tasks, written


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) to node and component, the smallest node that can be reached.

    In each round a node takes the smallest label around it, and then the label of that label, so
    labels travel at growing steps. Rounds end when no label has changed. Links may repeat and may
    be given in one direction; only longs are shuffled, and each round is read from a table.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(in_few_tasks(both.filter("a <> b").distinct()), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"))
    labels = written(in_few_tasks(labels), "labels")
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("least"))
        )
        near = labels.join(around, "node").select(
            "node", "label", F.least("label", "least").alias("least")
        )
        beyond = labels.select(F.col("node").alias("least"), F.col("label").alias("far"))
        after = near.join(beyond, "least").select(
            "node",
            F.least("least", "far").alias("label"),
            (F.least("least", "far") < F.col("label")).alias("changed"),
        )
        after = written(in_few_tasks(after), "labels")
        changed = after.filter("changed").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
