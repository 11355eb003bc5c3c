"""Connected components of a link table, in rounds of minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the smallest node reachable) of every node of a link.

    Each round gives a node the smallest label of itself and its neighbours and then the label of that label, so the
    rounds grow with the logarithm of the longest chain. Labels live in written tables; the driver sees one count a
    round. Links from a node to itself make it a node; null ends are left out.
    """
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("u"), F.col(b).alias("v"))
    arcs = materialize(ends.union(ends.select("v", "u")).distinct(), "arcs")
    labels = materialize(arcs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("c")), "labels")
    while True:
        near = arcs.join(labels.select(F.col("u").alias("v"), "c"), "v").groupBy("u").agg(F.min("c").alias("m"))
        lower = labels.join(near, "u").select("u", F.col("c").alias("was"), F.least("c", "m").alias("c"))
        jump = labels.select(F.col("u").alias("c"), F.col("c").alias("j"))
        moved = materialize(lower.join(jump, "c", "left").select("u", "was", F.least("c", F.coalesce("j", "c")).alias("c")), "labels")
        if moved.where("c <> was").isEmpty():
            return moved.select(F.col("u").alias("node"), F.col("c").alias("component"))
        labels = moved.select("u", "c")
