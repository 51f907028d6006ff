"""Connected components of a links table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.frames import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (a, b); the label is the least node of the component.

    Each round takes the least label among a node and its neighbours, then follows labels once, so that chains halve; it ends
    when nothing changes. Each round is stored. Minima combine before the shuffle, so a node with many links is no hot key.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        least = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        target = labels.select(F.col("node").alias("t"), F.col("label").alias("further"))
        new = stored(
            least.join(target, F.col("label") == F.col("t"), "left").select("node", "old", F.least("label", "further").alias("label")), "labels",
        )
        if new.where("label <> old").isEmpty():
            return labels
        labels = new.select("node", "label")
        labels._folder = new._folder  # for `scratch`
