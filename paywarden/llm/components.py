"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywarden.llm.storage import saved


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for each node of ``links`` (``a``, ``b``).

    Every round takes the smallest label of a node and its neighbours, then the
    label of that label, so chains shorten by half. Minima are combined before
    each shuffle, which keeps a node with very many links harmless. Labels are
    written each round; nothing but a count reaches the driver.
    """
    both = saved(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component"))
    labels = saved(labels, "components")
    while True:
        offered = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("offered")
        )
        nearer = labels.join(offered, "node").select(
            "node", "component", F.least("component", "offered").alias("nearer")
        )
        ahead = labels.select(F.col("node").alias("nearer"), F.col("component").alias("ahead"))
        moved = saved(
            nearer.join(ahead, "nearer").select(
                "node", F.col("component").alias("was"), F.least("nearer", "ahead").alias("component")
            ),
            "components",
        )
        labels = moved.drop("was")
        if moved.where("component <> was").isEmpty():
            return labels
