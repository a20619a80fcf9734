"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each linked node's component.

    ``links`` has columns ``a`` and ``b``.  Every node takes the smallest
    label among itself and its neighbours, then the label of its label
    (pointer jumping), until nothing changes; every round is written to the
    shared folder.  Only the number of changes reaches the driver.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen"))
        near = labels.join(seen, "node").select("node", "label", F.least("label", "seen").alias("near"))
        up = labels.select(F.col("node").alias("near"), F.col("label").alias("up"))
        after = stored(near.join(up, "near", "left").select(
            "node", "label", F.least("near", F.coalesce("up", "near")).alias("next")), "labels")
        changed = after.where("next <> label").limit(1).count()
        labels = after.select("node", F.col("next").alias("label"))
        if not changed:
            return labels
