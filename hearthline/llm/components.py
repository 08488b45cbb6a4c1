"""Connected components of a link table, by smallest labels and pointer jumping on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.session import staged


def components(links: DataFrame) -> DataFrame:
    """(node, label): for every node of links (a long, b long) the smallest node that it reaches.

    A round takes the smallest label among a node's neighbours and then that label's own label, so long
    chains shorten by jumps. Every round is a table of its own: a lost executor costs no earlier round.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "b", "label": "near"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = staged(lower, "labels")
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        after = staged(lower.join(jump, "label").select("node", "old", F.least("label", "beyond").alias("label")), "labels")
        if after.where("label <> old").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
