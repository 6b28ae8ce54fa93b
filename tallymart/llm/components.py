"""Connected components of links between long ids, as DataFrames all the way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.common import staged


def components(links: DataFrame, spark: SparkSession) -> DataFrame:
    """node, root of every node in ``links`` (columns a, b); the root is the component's smallest node.

    Each turn a node takes the smallest root among its neighbours' and its own, then the root's
    root, so chains shorten by half. A hub's many links are combined before they are moved; each
    turn is written to the shared folder.
    """
    ways = links.select("a", "b").union(links.select("b", "a")).distinct()
    ways = staged(ways, "links", spark)
    roots = ways.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), F.least("a", "least").alias("root")
    )
    roots = staged(roots, "roots", spark)
    while True:
        near = ways.join(roots.toDF("b", "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        lower = roots.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        jump = roots.toDF("at", "beyond")
        lower = lower.join(jump, F.col("root") == F.col("at")).select(
            "node", "old", F.least("root", "beyond").alias("root")
        )
        lower = staged(lower, "roots", spark)
        changed = not lower.where("root < old").isEmpty()
        roots = lower.select("node", "root")
        if not changed:
            return roots
