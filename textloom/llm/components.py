"""Connected components of a table of edges, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label for every node of ``edges`` (u, v: long); label is the smallest node reachable.

    Each round takes the least label among neighbours, aggregated before and
    after the shuffle, then lets every node take its label's label, so that the
    rounds grow with the logarithm of a component's width.  Each round's labels
    are a written table: lineage does not grow, and nothing comes to the driver
    but the number of labels that changed.
    """
    both = scratch.table(edges.where("u <> v").select("u", "v").union(edges.where("u <> v").select("v", "u")).distinct(), "edges")
    labels = scratch.table(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels0")
    for i in range(1, 200):
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("m"))
        mine = labels.join(near.withColumnRenamed("u", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        mine = scratch.table(mine, f"mine{i}")
        jump = mine.select(F.col("node").alias("at"), F.col("label").alias("next"))
        labels_next = scratch.table(
            mine.join(jump, F.col("label") == F.col("at")).select("node", F.col("next").alias("label"), (F.col("next") != F.col("old")).alias("changed")), f"labels{i}"
        )
        changed = labels_next.where("changed").limit(1).count()
        labels = labels_next.select("node", "label")
        scratch.drop(f"labels{i - 1}", f"mine{i}")
        if not changed:
            return labels
    raise RuntimeError("the components did not settle")
