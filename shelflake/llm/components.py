"""Connected components of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of links (a, b): the label is the least node it is connected
    with.

    Each round takes the least label of the neighbours, then the label of the label. Rounds are
    written to the shared folder, so that a lost executor costs one round at most.
    """
    spark = links.sparkSession
    both = stored(
        spark,
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = stored(
        spark,
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select(
            "node", F.least("node", "label").alias("label")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("via")
        )
        far = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        new = stored(
            spark,
            lower.join(far, "via", "left").select("node", "old", F.least("via", "far").alias("label")),
            "labels",
        )
        changed = not new.where("old <> label").isEmpty()
        labels = new.select("node", "label")
        if not changed:
            return labels
