"""Connected components of a link table, as repeated joins.

Every node carries the smallest id it knows of.  A round takes the smallest label
among a node's neighbours, then the label of that label (pointer jumping), and
stores the labels in the checkpoint folder.  A node with very many links is a hot
key of a plain join, which adaptive execution splits, and of a minimum, which is
aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import drop, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every node of ``links``; component is the smallest
    id reachable.  Nulls and links of a node with itself are left out."""
    one = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    both = stored(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("_m"))
                    .select("id", F.least("id", "_m").alias("component")), "labels")
    last = labels
    while True:
        seen = (both.join(labels.select(F.col("id").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("_m")))
        nearer = (labels.withColumnRenamed("component", "_old").join(seen, "id")
                  .select("id", "_old", F.least("_old", "_m").alias("_m")))
        jump = labels.select(F.col("id").alias("_m"), F.col("component").alias("_far"))
        after = stored(nearer.join(jump, "_m").select("id", "_old", F.least("_m", "_far").alias("component")), "labels")
        drop(last)
        labels, last = after.select("id", "component"), after
        if after.where("component < _old").isEmpty():
            drop(both)
            return labels
