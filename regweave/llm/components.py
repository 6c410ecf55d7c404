"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """node and label (the least node it is linked with, over any number of links) for rows (a, b).

    Each round a node takes the least label among itself and its neighbours, then its label's
    label; the labels of a round are a table in the shared folder, so no plan grows.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where("a <> b").distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("hop"))
        new = labels.join(near, "node").join(hop, "label", "left").select(
            "node", F.least("label", "near", "hop").alias("label"), (F.least("near", "hop") < F.col("label")).alias("moved")
        )
        new = written(new, "labels")
        labels = new.select("node", "label")
        if not new.where("moved").limit(1).count():
            return labels
