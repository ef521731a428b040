"""Connected components of a bipartite node-hub table by repeated minima, with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.session import materialize


def components(members: DataFrame) -> DataFrame:
    """``members (node, hub)`` -> ``(node, label)``: the smallest node reachable through shared hubs.

    Every round takes the minimum of each hub and then of each node (both sums are combined before the shuffle,
    so a hub with a third of all rows is no burden), then jumps to the label's own label. A round is written to
    the shared folder; rounds grow with the logarithm of the longest chain.
    """
    members = materialize(members.distinct(), "members")
    labels = materialize(members.groupBy("node").agg(F.min("hub").alias("_"), F.col("node").alias("label")).drop("_"), "labels")
    while True:
        hubs = members.join(labels, "node").groupBy("hub").agg(F.min("label").alias("low"))
        near = members.join(hubs, "hub").groupBy("node").agg(F.min("low").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = (
            near.join(jump, "label", "left")
            .select("node", F.least("label", F.coalesce("further", "label")).alias("label"))
        )
        after = materialize(after, "labels")
        changed = after.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old").limit(1).count()
        labels = after
        if not changed:
            return labels
