"""Connected components of a table of links, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import written


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of every node that occurs in `links` (a, b: bigint): the smallest node it is connected with.

    Each round a node takes the smallest label among its neighbours and itself, then the label of that label. Each
    round is written, so a lost executor repeats one round at most. Nothing but a count of changes reaches the driver.
    Null ends are left out; repeated links and loops change nothing.
    """
    links = links.where("a is not null and b is not null")
    both = written(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{name}-links",
    )
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node"), name)
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy("a")
            .agg(F.min("label").alias("_near"))
            .withColumnRenamed("a", "node")
        )
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("_old"), F.least("label", "_near").alias("label")
        )
        lower = written(lower, name)
        jumped = lower.join(
            lower.select(F.col("node").alias("label"), F.col("label").alias("_next")), "label", "left"
        ).select("node", "_old", F.least("label", F.coalesce("_next", "label")).alias("label"))
        jumped = written(jumped, name)
        if not jumped.where("label <> _old").limit(1).count():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
