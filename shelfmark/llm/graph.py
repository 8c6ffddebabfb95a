"""Connected components of an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut
from shelfmark.operators.merge import lookup_join


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of the edges ``a``, ``b`` (longs).

    Each round takes the smallest label among the neighbours and then the label's own label, so
    chains shrink to a fraction; the rounds grow with the logarithm of the longest path. Labels
    only fall, so an unchanged sum ends the loop. Every round is checkpointed.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = cut(both)
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")))
    before = None
    while True:
        # neighbours' labels; a node with many neighbours can be split, and minima merge before the shuffle
        heard = lookup_join(both, labels.withColumnRenamed("node", "b"), ["b"])
        heard = heard.select(F.col("a").alias("node"), "component")
        lowest = labels.union(heard).groupBy("node").agg(F.min("component").alias("at"))
        ends = lowest.select(F.col("node").alias("at"), F.col("at").alias("component"))
        labels = cut(lookup_join(lowest, ends, ["at"]).select("node", "component"))
        total = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if total == before:
            return labels
        before = total
