"""Connected components of links by least labels, in rounds written to a workspace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import Workspace


def components(links: DataFrame, space: Workspace) -> DataFrame:
    """``node, label`` for every end of ``links`` (a, b): the least node that it reaches.

    A round takes the least label among a node and its neighbours, then the label of that
    label, so labels travel over doubling distances. Rounds end when no label changes. Tables of a round, or of an
    earlier call in the same workspace, go once the next stand.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.union(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct()
    both = space.renew(both, "ends")
    labels = space.renew(
        both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("seen")), "other")
            .groupBy("node")
            .agg(F.min("seen").alias("seen"))
        )
        hooked = labels.join(near, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "seen").alias("label")
        )
        hooked = space.renew(hooked, "hooked")
        jumped = hooked.join(
            hooked.select(F.col("node").alias("label"), F.col("label").alias("further")), "label"
        ).select("node", "before", F.least("label", "further").alias("label"))
        labels = space.renew(jumped, "labels")
        if labels.where("label != before").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
