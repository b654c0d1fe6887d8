"""Connected components of links between integers, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``links`` (a, b): comp is the least
    node that is reachable.  Labels spread along links and along the labels
    themselves, so long chains halve in every round; nothing is collected."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        near = (both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        spread = label.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = spread.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = cut(spread.join(up, "comp", "left").select("node", "old", F.least("comp", F.coalesce("up", "comp")).alias("comp")))
        label = new.select("node", "comp")
        if new.where("comp <> old").isEmpty():
            return label
